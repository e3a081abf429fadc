"""Spelling variants: words one edit apart, found through one-edit neighbourhoods in a reduced alphabet."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.llm.common import body, documents, replaced, saved, saved_at

#: A word has this many code points and occurrences at least.
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Sizes of the alphabets. A letter's symbol is its code point modulo the size; by 256 letters keep apart.
ALPHABETS = (8, 32, 256)
#: Two classes of reduced words give at most this many pairs of words; larger ones go on to the next alphabet, and in
#: the last one a class is a single word.
PAIRS = 10_000
#: Distinct words, and bytes of them, that a task counts before it hands them over.
COUNTED = 250_000
COUNTED_BYTES = 8_000_000
#: Neighbours made at once.
CELLS = 1_000_000

# The letters, and their UTF-8 bytes. A-Z are lower-cased, the others stay as they are.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_OTHER = re.compile(rb"[\xc2\xc4-\xff][\x80-\xbf]*")
_PLAIN = bytes(b if 0x61 <= b <= 0x7A or b == 0xC3 or 0x80 <= b < 0xC0 else 0x20 for b in range(256))

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def runs(text: str) -> list[bytes]:
    """The maximal runs of letters of a text, A-Z lower-cased, in UTF-8."""
    return _OTHER.sub(b" ", text.encode()).lower().translate(_PLAIN).split()


#: Changes the runs of a document, given (doc_id, its runs), by removing and adding some: (removed, added).
Noise = Callable[[object, list[bytes]], tuple[list[bytes], list[bytes]]]


def planted(doc_id: object, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Loses a letter of the runs for which crc32 of `<doc_id>:<run>` is a multiple of 97, the one at that crc32 modulo
    the length. A null doc_id is written as nothing."""
    start = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    start = zlib.crc32(b":", start)
    crc32 = zlib.crc32
    hit = [word for word in words if not crc32(word, start) % 97]
    changed = []
    for word in hit:
        letters = word.decode()
        at = crc32(word, start) % len(letters)
        changed.append((letters[:at] + letters[at + 1:]).encode())
    return hit, changed


def word_counts(docs: DataFrame, noise: Noise | None = None) -> DataFrame:
    """word, n of the runs of letters of docs(doc_id, text), as changed by `noise`: those of LEAST_LENGTH code points
    and LEAST_COUNT occurrences at least. A task counts its own words and hands them over when they are many; the rest
    is a sum by word. A null text has no runs, repeated rows count each, other columns are ignored."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, held = Counter(), 0

        def counted() -> pd.DataFrame:
            words = [(word, n) for word, n in counts.items() if n and len(word) >= LEAST_LENGTH]
            return pd.DataFrame({
                "word": np.asarray([w.decode() for w, _ in words], object),
                "n": np.asarray([n for _, n in words], np.int64)})

        for batch in batches:
            ids = batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None)
            for doc_id, text in zip(ids, batch["body"]):
                words = runs(text)
                counts.update(words)
                if noise is not None:
                    removed, added = noise(doc_id, words)
                    counts.subtract(removed)
                    counts.update(added)
                held += len(text)
                if len(counts) > COUNTED or held > 20 * COUNTED_BYTES:
                    yield counted()
                    counts.clear()
                    held = 0
        yield counted()

    doc_id = F.col("doc_id").cast("string") if noise is not None else F.lit(None).cast("string")
    rows = docs.select(doc_id.alias("doc_id"), body().alias("body")).mapInPandas(run, "word string, n long")
    rows = rows.groupBy("word").agg(F.sum("n").alias("n"))
    return rows.where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def _symbols(words: list[str], size: int) -> np.ndarray:
    """Symbols (1 to size) of words of one length, a row each."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
    return codes.astype(np.uint64) % np.uint64(size) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _same_length(words: pd.Series) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places and words of one length, few enough for CELLS letters."""
    lengths = words.str.len().to_numpy()
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        step = max(1, CELLS // int(length))
        for at in range(0, len(places), step):
            some = places[at:at + step]
            yield some, words.iloc[some].tolist()


def reduced_keys(words: pd.Series, size: int) -> np.ndarray:
    """A number for each word's reduced word: its symbols as a polynomial modulo 2^64."""
    out = np.zeros(len(words), np.uint64)
    for places, some in _same_length(words):
        symbols = _symbols(some, size)
        out[places] = (symbols * _powers(symbols.shape[1])[-2::-1]).sum(axis=1, dtype=np.uint64)
    return out.view(np.int64)


def neighbourhood(symbols: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number) of every word of the reduced alphabet that differs from a row by at most one edit: the row itself,
    one symbol deleted, replaced, or inserted. Each is named once. Numbers follow from those of the parts before and
    behind the edit, so a neighbour costs the same whatever the length; CELLS of them are made at a time."""
    m, length = symbols.shape
    power = _powers(length + 1)
    terms = symbols * power[length - 1::-1] if length > 1 else symbols.copy()
    behind = np.zeros((m, length + 1), np.uint64)  # of the symbols from a place on
    behind[:, :length] = np.cumsum(terms[:, ::-1], axis=1)[:, ::-1]
    whole = behind[:, 0]
    rows = np.arange(m)
    yield rows, whole
    step = max(1, CELLS // (m * (len(alphabet) + 1)))
    for first in range(0, length + 1, step):
        at = np.arange(first, min(first + step, length + 1))
        inside = at[at < length]
        here = symbols[:, inside]
        before = (whole[:, None] - behind[:, inside]) * _INVERSE
        # of several equal symbols side by side the first is deleted, and one like them is inserted behind them
        new = np.ones(here.shape, bool)
        new[:, inside > 0] = here[:, inside > 0] != symbols[:, inside[inside > 0] - 1]
        row, col = np.nonzero(new)
        yield row, (before + behind[:, inside + 1])[row, col]
        for symbol in alphabet:
            row, col = np.nonzero(here != symbol)
            yield row, (whole[:, None] + (symbol - here) * power[length - 1 - inside])[row, col]
            beside = np.ones((m, len(at)), bool)
            beside[:, at < length] = here != symbol
            row, col = np.nonzero(beside)
            yield row, ((whole[:, None] - behind[:, at]) * _BASE + symbol * power[length - at] + behind[:, at])[row, col]


def _keyed(words: DataFrame, size: int) -> DataFrame:
    @F.pandas_udf("long")
    def key(word: pd.Series) -> pd.Series:
        return pd.Series(reduced_keys(word, size))

    return words.withColumn("key", key("word"))


def _neighbours(classes: DataFrame, size: int) -> DataFrame:
    """key, size, near of classes(key, size, word): the numbers of the neighbours of each reduced word."""
    alphabet = np.unique(np.asarray(LETTERS, np.uint64) % np.uint64(size)) + np.uint64(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            key, members = batch["key"].to_numpy(), batch["size"].to_numpy()
            for places, some in _same_length(batch["word"]):
                # a word has some 2 x |alphabet| x length neighbours, which leave in parts
                step = max(1, CELLS // (2 * len(alphabet) * len(some[0])))
                for at in range(0, len(some), step):
                    own = places[at:at + step]
                    for row, near in neighbourhood(_symbols(some[at:at + step], size), alphabet):
                        yield pd.DataFrame({
                            "key": key[own[row]], "size": members[own[row]], "near": near.view(np.int64)})

    return classes.mapInPandas(run, "key long, size long, near long")


def _links(words: DataFrame, size: int, last: bool, pairs: int) -> tuple[DataFrame, DataFrame | None]:
    """(a, b), a < b, of words(word, n) one edit apart, and the words of classes too large for this alphabet."""
    keyed = saved(_keyed(words, size), "reduced")
    classes = saved(keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("word").alias("word")), "reduced-words")
    near = classes.select(F.col("key").alias("near"), F.col("size").alias("near_size"))
    # the vocabulary's side has one row for each key, so no key can be hot in its hash table
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = _neighbours(classes.repartition(tasks, "key"), size).join(near.hint("shuffle_hash"), "near").where("key <= near")
    met = saved(met, "met")
    fits = F.lit(True) if last else F.col("size") * F.col("near_size") <= pairs
    left = keyed.select("key", F.col("word").alias("a"))
    right = keyed.select(F.col("key").alias("near"), F.col("word").alias("b"))
    found = met.where(fits).select("key", "near").join(left, "key").join(right, "near")
    found = found.where((F.col("key") != F.col("near")) | (F.col("a") < F.col("b")))
    found = found.where(F.levenshtein("a", "b", 1) == 1)
    links = saved(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "links")
    large = met.where(~fits).select(F.explode(F.array("key", "near")).alias("key")).distinct()
    if last or large.isEmpty():
        return links, None
    return links, saved(keyed.join(large, "key", "left_semi").select("word", "n"), "large")


def near_words(words: DataFrame, alphabets: tuple[int, ...] = ALPHABETS, pairs: int = PAIRS) -> DataFrame:
    """a, b, a < b: the pairs of words(word, n) that differ by exactly one inserted, deleted or replaced code point.

    The reduced vocabulary is joined with the full one-edit neighbourhoods of its own words; classes that meet are
    compared word by word. Two large classes, such as those of many short words with the same symbols, are left to a
    larger alphabet, with the same method, instead of comparing all their pairs."""
    out, rest = None, words
    for size in alphabets:
        links, rest = _links(rest, size, size == alphabets[-1], pairs)
        out = links if out is None else out.unionByName(links)
        if rest is None:
            return out if size == alphabets[0] else out.distinct()
    return out.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root of forms(word, form): where the forms of forms end. Each round doubles the length of the way; a form
    has twice the occurrences of its word, so a way has fewer steps than a count has bits."""
    ways, path = saved_at(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways, path = replaced(ways.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ways", path)
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def variants(words: DataFrame, alphabets: tuple[int, ...] = ALPHABETS, pairs: int = PAIRS) -> DataFrame:
    """word, form, root, n, n_near, form_n of words(word, n), each word once.

    The form of a word is its near word with the most occurrences (the smallest of several), if these are twice its
    own at least; the root is where the forms end, the word itself without a form. An empty table gives no rows."""
    links = near_words(words, alphabets, pairs)
    own = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(own, "b")
    best = both.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), "b")).alias("best"))
    out = words.join(best.withColumnRenamed("a", "word"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best")).alias("best"))
    out = saved(out.select("word", "n", "n_near", F.col("best.b").alias("form"), (-F.col("best.less")).alias("form_n")),
                "forms")
    ends = roots(out.where("form is not null").select("word", "form"))
    return out.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(saved(word_counts(documents(spark, sf_dir), planted), "vocabulary"))


ORACLE = """
WITH RECURSIVE
bits AS (
  SELECT list(c ORDER BY i) AS crcs FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
    FROM range(256) t(i))),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END))),
      lambda c, b: xor(c >> 8, crcs[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM runs, bits),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END
      AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (
  SELECT word, n, length(word) AS len, i, substr(word, 1, i) || substr(word, i + 2) AS cut
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b, b.n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
best AS (SELECT a, count(*) AS n_near, min({'less': -n, 'b': b}) AS best FROM pairs GROUP BY a),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 2 * n THEN best.b END AS form,
         CASE WHEN -best.less >= 2 * n THEN -best.less END AS form_n
  FROM words LEFT JOIN best ON a = word),
ways AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT ways.word, forms.form FROM ways JOIN forms ON forms.word = ways.at WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN ways w ON w.word = f.word JOIN forms e ON e.word = w.at AND e.form IS NULL
"""
