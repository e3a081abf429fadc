"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.llm.common import body, documents, hold, labels, small_table

#: A document is good from this score on.
GOOD_FROM = 0.3
#: Bounds of the training sample: labelled documents, and lines of all of them.
SAMPLE_DOCS = 6_000
SAMPLE_LINES = 200_000
#: No document gives more than one in so many of these lines, so that a long one does not end the sample.
LONGEST_SHARE = 20
#: Characters, and lines, whose features are computed at once. A text of more lines is computed in stretches of so many.
PORTION = 1 << 18
PORTION_LINES = 1 << 13
#: Passes over the sample, their step, and the weight of the penalty.
STEPS = 300
STEP = 0.1
PENALTY = 1e-4

_BYTES = np.arange(256)
_BLANK = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_KINDS = np.stack([
    ~_BLANK,  # all but blanks
    (_BYTES >= 65) & (_BYTES <= 90),  # capitals
    (_BYTES >= 48) & (_BYTES <= 57),  # digits
    np.isin(_BYTES, [ord(c) for c in "#*$%&|<>{}[]\\^~`@_=+/"]),  # symbols
    np.isin(_BYTES, [ord(c) for c in "!?"]),
    np.isin(_BYTES, [ord(c) for c in ".,;:'\"()-"]),
    _BYTES >= 128,
]).astype(np.uint8)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
FEATURES = 13


def line_features(
    texts: list[str], earlier: set[int] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of the texts (FEATURES columns), bytes of the lines, lines per text. `earlier` holds the
    numbers of lines of the same text that came before, and gets those of the lines that are not blank."""
    raw = [text.encode() for text in texts]
    lines = np.asarray([one.count(b"\n") + 1 for one in raw], np.int64)
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = (ends - starts).astype(float)
    counts = np.stack([np.add.reduceat(kind[data], starts, dtype=np.int64) for kind in _KINDS]).astype(float)
    blank = _BLANK[data]
    first = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    last = np.flatnonzero(~blank & np.concatenate((blank[1:], [True]))) + 1
    line = np.searchsorted(starts, first, "right") - 1
    # words as numbers: a polynomial over their bytes, taken from running sums
    powers = np.cumprod(np.full(len(data), _ODD), dtype=np.uint64)
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), sums))
    back = np.cumprod(np.full(len(data), _INVERSE), dtype=np.uint64)
    words = (sums[last] - sums[first]) * back[first] if len(first) else np.zeros(0, np.uint64)
    again = np.zeros(len(words), bool)
    for lag in (1, 2, 3):
        again[lag:] |= (words[lag:] == words[:-lag]) & (line[lag:] == line[:-lag])
    n = np.bincount(line, minlength=len(starts)).astype(float)
    repeated = np.bincount(line, weights=again, minlength=len(starts))
    # lines as numbers, to see whether the text had the line before
    whole = (sums[ends] - sums[starts]) * back[starts]
    text = np.repeat(np.arange(len(raw)), lines)
    seen = pd.DataFrame({"t": text, "h": whole}).duplicated().to_numpy() & (n > 0)
    if earlier is not None:
        own = whole.tolist()
        seen |= np.fromiter((h in earlier for h in own), bool, len(own)) & (n > 0)
        earlier.update(h for h, filled in zip(own, n > 0) if filled)
    chars, word = np.maximum(counts[0], 1), np.maximum(n, 1)
    shares = [counts[k] / chars for k in range(1, len(_KINDS))]
    columns = [np.log1p(size), np.log1p(n), counts[0] / word, *shares, repeated / word, seen,
               counts[3] / word, (n == 0)]
    return np.stack(columns, axis=1), size, lines


def portions(texts: list[str], most: int = PORTION, lines: int = PORTION_LINES) -> Iterator[list[str]]:
    """The texts in lists of about `most` characters and `lines` lines, or one longer text."""
    held, size, count = [], 0, 0
    for text in texts:
        own = text.count("\n") + 1
        if held and (size + len(text) > most or count + own > lines):
            yield held
            held, size, count = [], 0, 0
        held.append(text)
        size += len(text)
        count += own
    if held:
        yield held


def stretches(text: str, lines: int = PORTION_LINES) -> Iterator[str]:
    """A text in parts of so many lines, without the line feeds between the parts."""
    at = 0
    while at <= len(text):
        end = at - 1
        for _ in range(lines):
            end = text.find("\n", end + 1)
            if end < 0:
                end = len(text)
                break
        yield text[at:end]
        at = end + 1


def with_neighbours(x: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after in its text, and a constant."""
    first = np.concatenate(([0], np.cumsum(lines)[:-1]))
    before, after = np.roll(x, 1, axis=0), np.roll(x, -1, axis=0)
    before[first] = 0
    after[first + lines - 1] = 0
    return np.hstack([x, before, after, np.ones((len(x), 1))])


class Chain:
    """Two labels, bad and good, along the lines of a text."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, mean: np.ndarray, spread: np.ndarray):
        self.weights, self.moves, self.mean, self.spread = weights, moves, mean, spread

    def inputs(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return with_neighbours((x - self.mean) / self.spread, lines)

    def marginals(self, inputs: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line by the forward-backward pass, and the expected moves between labels. Texts run
        side by side, longest first, so that a step works on all that have so many lines."""
        emit = np.stack([np.zeros(len(inputs)), np.clip(inputs @ self.weights, -50, 50)], axis=1)
        order = np.argsort(-lines, kind="stable")
        start = (np.cumsum(lines) - lines)[order]
        active = np.searchsorted(-lines[order], -np.arange(lines.max(initial=0)), "left")
        forth, behind = np.zeros_like(emit), np.zeros_like(emit)
        for t, n in enumerate(active):
            at = start[:n] + t
            if t == 0:
                forth[at] = emit[at]
                continue
            into = forth[at - 1][:, :, None] + self.moves
            forth[at] = np.logaddexp(into[:, 0], into[:, 1]) + emit[at]
        for t in range(len(active) - 2, -1, -1):
            at = start[:active[t + 1]] + t
            out = self.moves + (emit[at + 1] + behind[at + 1])[:, None, :]
            behind[at] = np.logaddexp(out[:, :, 0], out[:, :, 1])
        both = forth + behind
        total = np.logaddexp(both[:, 0], both[:, 1])
        inner = np.ones(len(emit), bool)
        inner[start] = False
        at = np.flatnonzero(inner)
        pair = forth[at - 1][:, :, None] + self.moves + (emit[at] + behind[at])[:, None, :] - total[at][:, None, None]
        return np.exp(both[:, 1] - total), np.exp(pair).sum(axis=0)


    def long_odds(self, text: str) -> float:
        """What document_odds gives for a text of many lines: features are computed stretch by stretch, each with the line
        before and after it, and the messages go from line to line, so that a line costs a few numbers."""
        earlier: set[int] = set()
        scores, sizes, before, waiting = [], [], np.zeros(FEATURES), None

        def emitted(x: np.ndarray, after: np.ndarray) -> np.ndarray:
            inputs = np.hstack([x, np.vstack([before, x[:-1]]), np.vstack([x[1:], after]), np.ones((len(x), 1))])
            return np.clip(inputs @ self.weights, -50, 50)

        for part in stretches(text):
            x, size, _ = line_features([part], earlier)
            x = (x - self.mean) / self.spread
            if waiting is not None:
                scores.append(emitted(waiting, x[0]))
                before = waiting[-1]
            waiting = x
            sizes.append(size)
        scores.append(emitted(waiting, np.zeros(FEATURES)))
        emit, weight = np.concatenate(scores), np.concatenate(sizes) + 1
        (bb, bg), (gb, gg) = self.moves.tolist()
        # log odds are all that matters: of good against bad, so far and from here on
        forth, odds = np.empty(len(emit)), 0.0
        for t, score in enumerate(emit.tolist()):
            if t:
                odds = _log_sum(bg, odds + gg) - _log_sum(bb, odds + gb)
            odds += score
            forth[t] = odds
        total, behind = 0.0, 0.0
        for t in range(len(emit) - 1, -1, -1):
            total += weight[t] / (1 + math.exp(-max(-700.0, min(700.0, forth[t] + behind))))
            ahead = emit[t] + behind
            behind = _log_sum(gb, gg + ahead) - _log_sum(bb, bg + ahead)
        mean = min(max(total / weight.sum(), 1e-6), 1 - 1e-6)
        return math.log(mean) - math.log1p(-mean)


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(max(low - high, -700.0)))


def document_odds(good: np.ndarray, size: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Log odds of the mean P(good) of a text's lines, weighted by their length; an empty text is one line."""
    first = np.cumsum(lines) - lines
    weight = size + 1
    mean = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean) - np.log1p(-mean)


def _adam(gradient, size: int) -> np.ndarray:
    """Climbs along the gradient of a concave function from 0."""
    at, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, STEPS + 1):
        g = gradient(at)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        at = at + STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return at


def fitted(x: np.ndarray, size: np.ndarray, lines: np.ndarray, good: np.ndarray) -> tuple[Chain, np.ndarray]:
    """The chain with the largest likelihood, every line bearing the label of its document, and the slope
    and shift that turn document odds into a probability (a logistic fit to the same documents)."""
    spread = x.std(axis=0)
    chain = Chain(np.zeros(3 * FEATURES + 1), np.zeros((2, 2)), x.mean(axis=0), np.where(spread > 0, spread, 1))
    inputs, label = chain.inputs(x, lines), np.repeat(good, lines)
    inner = np.ones(len(x), bool)
    inner[np.cumsum(lines) - lines] = False
    seen = np.zeros((2, 2))
    for value in (0, 1):
        seen[value, value] = np.sum(inner & (label == value))
    n = len(x)

    def gradient(at: np.ndarray) -> np.ndarray:
        chain.weights, chain.moves = at[:-4], at[-4:].reshape(2, 2)
        p, moves = chain.marginals(inputs, lines)
        return np.concatenate((inputs.T @ (label - p), (seen - moves).ravel())) / n - PENALTY * at

    best = _adam(gradient, 3 * FEATURES + 5)
    chain.weights, chain.moves = best[:-4], best[-4:].reshape(2, 2)
    odds = document_odds(chain.marginals(inputs, lines)[0], size, lines)
    both = np.stack([odds, np.ones(len(odds))], axis=1)
    chance = lambda at: 1 / (1 + np.exp(-np.clip(both @ at, -50, 50)))
    return chain, _adam(lambda at: both.T @ (good - chance(at)) / len(odds) - PENALTY * at, 2)


def training_sample(docs: DataFrame, marked: DataFrame) -> pd.DataFrame:
    """quality, lines, size and x (features, line by line) of labelled documents outside the held-out fold: at
    most SAMPLE_DOCS with SAMPLE_LINES lines in all, those with the smallest hashes of their texts; no document gives
    more than one in LONGEST_SHARE of these lines. It is an error if the sample lacks one of two labels. Equal texts are
    taken once, as bad if their labels differ; a document with labels of both kinds is left out. Tasks compute
    the features."""
    quality = marked.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("_low"), F.max("quality").alias("_high")).where("_low = _high")
    texts = docs.select("doc_id", body().alias("body")).withColumn("h", F.xxhash64("body"))
    rows = texts.where(F.col("doc_id").isNotNull() & ~held_out())
    # what is joined, sorted and collected are numbers; the texts of the sample are then picked out where they lie
    rows = rows.select("doc_id", "h", (F.regexp_count("body", F.lit("\n")) + 1).alias("lines"))
    rows = rows.join(quality.withColumnRenamed("doc_id", "_marked"), F.col("doc_id") == F.col("_marked"))
    keys = rows.groupBy("h").agg(F.min("_low").alias("quality"), F.min("lines").alias("lines"))
    few = keys.where(F.col("lines") <= SAMPLE_LINES // LONGEST_SHARE)
    found = few.orderBy("h").limit(SAMPLE_DOCS).toPandas()
    found = found[found["lines"].cumsum() <= SAMPLE_LINES]
    if found["quality"].nunique() < 2 and keys.select("quality").distinct().count() == 2:
        raise ValueError("the training sample lacks a label that documents have")
    keys = found
    picked = [(int(h), int(q)) for h, q in zip(keys["h"], keys["quality"])]
    sample = texts.join(F.broadcast(small_table(docs.sparkSession, picked, "h long, quality int")), "h")
    sample = sample.groupBy("h", "quality").agg(F.min("body").alias("body"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (h, quality), text in zip(batch[["h", "quality"]].to_numpy().tolist(), batch["body"]):
                x, size, lines = line_features([text])
                yield pd.DataFrame({"h": [h], "quality": [quality], "lines": lines, "size": [size], "x": [x.ravel()]})

    schema = "h long, quality int, lines long, size array<double>, x array<double>"
    return sample.select("h", "quality", "body").mapInPandas(run, schema).toPandas().sort_values("h")


def held_out():
    """Whether the document belongs to the fold that is never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def quality_model(docs: DataFrame, marked: DataFrame) -> tuple[Chain, np.ndarray] | None:
    """Fitted to the training sample; None if that lacks one of the two labels."""
    sample = training_sample(docs, marked)
    if sample["quality"].nunique() < 2:
        return None
    x = np.concatenate(sample["x"].to_list()).reshape(-1, FEATURES)
    size, lines = np.concatenate(sample["size"].to_list()), sample["lines"].to_numpy()
    return fitted(x, size, lines, sample["quality"].to_numpy(float))


def text_odds(chain: Chain, texts: list[str]) -> np.ndarray:
    """Log odds of each text."""
    out = [np.zeros(0)]
    for held in portions(texts):
        if len(held) == 1 and held[0].count("\n") >= PORTION_LINES:
            out.append(np.asarray([chain.long_odds(held[0])]))
        else:
            x, size, lines = line_features(held)
            out.append(document_odds(chain.marginals(chain.inputs(x, lines), lines)[0], size, lines))
    return np.concatenate(out)


def scored(docs: DataFrame, model: tuple[Chain, np.ndarray] | None, name: str = "score") -> DataFrame:
    """The rows of docs with `name` (0 to 1) added, computed from the whole text alone; other columns stay where they
    are, and one of that name goes.

    A null text is empty; an empty text is a single empty line. Without a model every score is 0.5."""
    if model is None:
        return docs.drop(name).withColumn(name, F.lit(0.5))
    chain, scale = model

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hold("quality_crf", lambda: None)
        for texts in batches:
            odds = text_odds(chain, texts.tolist())
            yield pd.Series(1 / (1 + np.exp(-np.clip(scale[0] * odds + scale[1], -50, 50))))

    return docs.drop(name).withColumn(name, score(body()))


def good_documents(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows of docs that the classifier does not reject."""
    rows = scored(docs, quality_model(docs, marked), "_quality_score")
    return rows.where(F.col("_quality_score") >= GOOD_FROM).select(*docs.columns)


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = scored(docs, quality_model(docs, labels(spark, sf_dir)))
    return rows.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))
