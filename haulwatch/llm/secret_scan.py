"""Secrets in texts: fixed patterns, and character Markov models that tell random strings from identifiers."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.llm.common import body, documents

# The patterns, in the order of their kinds. ASCII letters only, where case does not matter.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run is found whole, so the length can be part of the pattern
KINDS = ("assign", "access", "hex", "markov")

#: What the models read, and the shortest string they judge.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SHORTEST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
#: Random strings of each alphabet in the labelled samples.
SAMPLE_STRINGS = 2_000
#: Characters of text whose strings are counted at once.
PORTION = 1 << 18
ALPHABETS = (
    "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-",
)
#: A string is a secret from this log-likelihood ratio on: odds of one to 160,000 against a string being random.
THRESHOLD = 12.0
SEED = 7

_CODE = np.full(128, -1, np.int32)
_CODE[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
_N = len(SYMBOLS)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what the fixed patterns find, in code points, end exclusive."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def transitions(strings: list[str]) -> np.ndarray:
    """How often each symbol follows each other one; row _N holds the first symbols."""
    codes = _CODE[np.frombuffer(("\n" + "\n".join(strings)).encode("ascii"), np.uint8)]
    last, after = codes[:-1], codes[1:]
    pairs = np.where(last < 0, _N, last)[after >= 0] * _N + after[after >= 0]
    return np.bincount(pairs, minlength=(_N + 1) * _N).reshape(_N + 1, _N).astype(float)


def log_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a first-order chain, each row smoothed towards the frequencies of the symbols."""
    symbols = counts.sum(axis=0) + 1
    prior = symbols / symbols.sum()
    return np.log((counts + 5 * prior) / (counts.sum(axis=1, keepdims=True) + 5))


def random_strings() -> list[str]:
    """Labelled samples of random strings, by rule."""
    rng = np.random.default_rng(SEED)
    return ["".join(rng.choice(list(alphabet), rng.integers(SHORTEST, 64)))
            for alphabet in ALPHABETS for _ in range(SAMPLE_STRINGS)]


def plain_strings() -> list[str]:
    """Labelled samples of strings that are regular, by rule: rulers, series, numbers, dates, versions."""
    rng = np.random.default_rng(SEED)
    rulers = [symbol * n for symbol in SYMBOLS for n in (16, 32, 64)]
    series = [(2 * SYMBOLS)[i:i + 24] for i in range(len(SYMBOLS))]
    parts = rng.integers(0, 10**9, (SAMPLE_STRINGS, 3))
    numbers = [f"{a:09d}{b:09d}" for a, b, _ in parts]
    dates = [f"20{a % 30:02d}-{b % 12 + 1:02d}-{c % 28 + 1:02d}-{a % 24:02d}-{b % 60:02d}" for a, b, c in parts]
    versions = [f"v{a % 30}-{b % 100}-{c % 1000}_{a % 10}/{b % 100}+{c % 100}" for a, b, c in parts]
    return 20 * (rulers + series) + numbers + dates + versions


def scores(strings: list[str], ratio: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each string, random against ordinary."""
    codes = _CODE[np.frombuffer("".join(strings).encode("ascii"), np.uint8)]
    starts = np.cumsum([0, *map(len, strings[:-1])])
    before = np.concatenate(([_N], codes[:-1]))
    before[starts] = _N
    return np.add.reduceat(ratio[before, codes], starts)


def _parts(start: int, end: int, taken: list[tuple[int, int]], at: int) -> tuple[list[tuple[int, int]], int]:
    """What is left of (start, end) outside the sorted, disjoint spans `taken`, of which those before `at` end before
    it; and the first one that may matter to what follows."""
    while at < len(taken) and taken[at][1] <= start:
        at += 1
    parts, i = [], at
    while i < len(taken) and taken[i][0] < end:
        if start < taken[i][0]:
            parts.append((start, taken[i][0]))
        start = max(start, taken[i][1])
        i += 1
    return (parts + [(start, end)] if start < end else parts), at


def _merged(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end, _ in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def markov_spans(text: str, taken: list[tuple[int, int, str]], ratio: np.ndarray) -> list[tuple[int, int, str]]:
    """Strings that the models call random, but for what lies in the spans found before. A string that reaches into such
    a span is judged as a whole; of a random one, those parts outside are added that are random rather than ordinary
    by themselves too."""
    found, at, spans = [], 0, _merged(taken)
    for m in CANDIDATE.finditer(text):
        parts, at = _parts(m.start(), m.end(), spans, at)
        if parts:
            found.append((m.start(), m.end(), parts))
    if not found:
        return []
    high = scores([text[a:z] for a, z, _ in found], ratio) >= THRESHOLD
    parts = [(a, z, (a, z) == (start, end)) for (start, end, parts), is_high in zip(found, high) if is_high for a, z in parts]
    if not parts:
        return []
    own = scores([text[a:z] for a, z, _ in parts], ratio)
    return [(a, z, "markov") for (a, z, whole), score in zip(parts, own) if whole or score > 0]


def _random(text: str, spans: list[tuple[int, int, str]]) -> list[str]:
    return [s for a, z, _ in spans for s in CANDIDATE.findall(text[a:z])]


def _identifiers(text: str, spans: list[tuple[int, int, str]]) -> list[str]:
    """Words of a text outside the base spans, and compounds as programs use them."""
    edges, at = [], 0
    for start, end in _merged(spans):
        edges.append(text[at:start])
        at = end
    words = [w for part in [*edges, text[at:]] for w in IDENTIFIER.findall(part)]
    pairs = list(zip(words[::2], words[1::2]))
    return (words + [f"{a}_{b}".lower() for a, b in pairs] + [a + b.capitalize() for a, b in pairs]
            + [f"{a}-{b}/{a}".lower() for a, b in pairs])


def text_transitions(texts: list[str]) -> np.ndarray:
    """Transitions of the random strings and of the identifiers of texts, counted in portions."""
    tables, strings, held = np.zeros((2, _N + 1, _N)), ([], []), 0
    for i, text in enumerate(texts):
        spans = base_spans(text)
        strings[0].extend(_random(text, spans))
        strings[1].extend(_identifiers(text, spans))
        held += len(text)
        if held >= PORTION or i == len(texts) - 1:
            for table, some in zip(tables, strings):
                table += transitions(some)
                some.clear()
            held = 0
    return tables


def trained_ratio(docs: DataFrame) -> np.ndarray:
    """log P(next | last) under the model of random strings less that under the model of identifiers.

    Random strings are labelled by the rule that makes them and by the base patterns; identifiers are all other words
    of all documents. Every task counts transitions; what reaches the driver are the two tables of counts."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = np.zeros((2, _N + 1, _N))
        for batch in batches:
            tables += text_transitions(batch["body"].tolist())
        kind, last, next_ = np.nonzero(tables)
        yield pd.DataFrame({"kind": kind, "last": last, "next": next_, "n": tables[kind, last, next_]})

    tables = np.zeros((2, _N + 1, _N))
    counted = docs.select(body().alias("body")).mapInPandas(count, "kind long, last long, next long, n double")
    for row in counted.groupBy("kind", "last", "next").agg(F.sum("n").alias("n")).collect():
        tables[row["kind"], row["last"], row["next"]] = row["n"]
    random = log_model(tables[0] + transitions(random_strings()))
    return random - log_model(tables[1] + transitions(plain_strings()))


def joined(spans: list[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then kind."""
    order = sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in order)


def secrets(docs: DataFrame, ratio: np.ndarray | None = None) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov.

    Whole texts are searched, long ones like others; a null text is empty and has no spans. Spans of different
    kinds may overlap; a string of the models never overlaps one of the patterns. Rows are independent of each
    other. An empty table trains on the rule-made strings alone. Other columns are ignored."""
    ratio = trained_ratio(docs) if ratio is None else ratio

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["body"]:
                base = base_spans(text)
                more = markov_spans(text, base, ratio)
                n = [sum(kind == k for _, _, kind in base) for k in KINDS[:3]]
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            found = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"])
            found.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield found

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"
    return docs.select("doc_id", body().alias("body")).mapInPandas(scan, f"doc_id {kind}, {schema}")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(documents(spark, sf_dir))
