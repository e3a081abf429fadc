"""Repeated runs of lines, found by a suffix array over line ids; later copies are deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haulwatch.llm.common import WORD, body, documents, saved

#: A run counts as repeated text from so many words on.
MIN_WORDS = 50
#: The key of a document: its id, and a hash of its text where rows share an id.
DOC = ("doc_id", "text_hash")


def _ranked(groups: DataFrame, *keys: str) -> DataFrame:
    """The groups with their place in the order of the keys, found by range: places inside a range, and
    the number of groups in the ranges before it (one row per range)."""
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = groups.repartitionByRange(n, *keys).withColumn("range", F.spark_partition_id())
    dealt = saved(dealt, "line-ranks")
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    before = sizes.select(
        "range", F.coalesce(F.sum("rows").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        .alias("before"))
    inside = dealt.withColumn("place", F.row_number().over(W.partitionBy("range").orderBy(*keys)))
    return inside.join(before, "range").select(*keys, (F.col("before") + F.col("place")).alias("rank"))


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """Lines with a word, numbered within their document (k; `at` counts all lines), with the shortest
    blocks of min_words words that begin and that end there: their number of lines (`ahead`, `back`; null
    where the document is too short) and where they end and begin (`ahead_to`, `back_from`)."""
    lines = F.transform(F.split("body", "\n", -1), lambda line, at: F.struct(at.alias("at"), line.alias("line")))
    rows = docs.select(
        "doc_id", F.xxhash64("body").alias("text_hash"),
        F.posexplode(F.filter(lines, lambda x: x["line"].rlike(WORD))).alias("k", "x"))
    rows = rows.select(
        *DOC, "k", F.col("x.at").alias("at"), F.unhex(F.md5("x.line")).alias("line_id"),
        F.regexp_count("x.line", F.lit(WORD)).cast("long").alias("words"))
    # the same row twice (a repeated document) is one line
    doc = W.partitionBy(*DOC)
    rows = rows.dropDuplicates([*DOC, "k"])
    rows = rows.withColumn("upto", F.sum("words").over(doc.orderBy("k").rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.withColumn("before", F.col("upto") - F.col("words"))
    ahead = doc.orderBy("before").rangeBetween(0, min_words - 1)
    back = doc.orderBy("upto").rangeBetween(-(min_words - 1), 0)
    rows = rows.select(
        *DOC, "k", "at", "line_id", "before", "upto", F.max("upto").over(doc).alias("total"),
        F.count(F.lit(1)).over(ahead).alias("ahead"), F.max("at").over(ahead).alias("ahead_to"),
        F.count(F.lit(1)).over(back).alias("back"), F.min("at").over(back).alias("back_from"))
    enough, had = F.col("total") - F.col("before") >= min_words, F.col("upto") >= min_words
    return rows.select(
        *DOC, "k", "at", "line_id", F.when(enough, F.col("ahead")).alias("ahead"), "ahead_to",
        F.when(had, F.col("back")).alias("back"), "back_from")


def _level(length: Column) -> Column:
    """The largest h with 2^h <= length."""
    return F.length(F.bin(length)) - 1


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Maximal runs of lines to delete: doc_id, text_hash, first, last (line numbers from 0, inclusive).

    Lines are the letters of a text that is sorted by prefix doubling: the ranks of single lines come
    from a sort of their ids, the ranks of blocks of 2h lines from the pair of ranks at k and k + h.
    A suffix whose block has no second occurrence cannot start a longer repeat and leaves the rounds,
    which end when none is left or h exceeds the longest block asked for. Suffixes with equal ranks are
    an interval of the suffix array with a common prefix of at least that many lines. A run is long
    enough if it has min_words words; it is, line by line, the union of the shortest such blocks that
    begin or end at its lines, so that the intervals of exactly these blocks (the common prefix of any
    length is covered by two powers of two) reveal the maximal runs. In each interval all but the
    occurrence with the smallest (doc_id, text hash, line) are later copies. Lines without a word neither
    count nor break a run; inside a deleted run they go with it."""
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", body().alias("body"))
    lines = saved(_lines(rows, min_words), "lines")
    forth = lines.where("ahead IS NOT NULL").select(
        *DOC, F.col("k").alias("start"), F.col("ahead").alias("n"), F.col("at").alias("first"),
        F.col("ahead_to").alias("last"))
    # a block of one line is found in both directions
    back = lines.where("back > 1").select(
        *DOC, (F.col("k") - F.col("back") + 1).cast("int").alias("start"), F.col("back").alias("n"),
        F.col("back_from").alias("first"), F.col("at").alias("last"))
    groups = lines.groupBy("line_id").agg(F.count(F.lit(1)).alias("of")).where("of > 1").drop("of")
    ranks = saved(lines.join(_ranked(groups, "line_id"), "line_id").select(*DOC, "k", "rank"), "line-ranks")
    blocks = forth.unionByName(back).withColumn("level", _level(F.col("n")))
    # only blocks of which the first line is repeated
    begin = ranks.select(*DOC, F.col("k").alias("start"))
    blocks = saved(blocks.join(begin, [*DOC, "start"]).dropDuplicates([*DOC, "start", "n"]), "line-blocks")
    most = blocks.agg(F.max("level")).first()[0]
    later, h = [], 1
    for level in range(0 if most is None else most + 1):
        later.append(_later_copies(blocks.where(F.col("level") == level), ranks, level, h))
        if level == most:
            break
        pairs = ranks.join(ranks.select(*DOC, (F.col("k") - h).alias("k"), F.col("rank").alias("next")), [*DOC, "k"])
        pairs = pairs.select(*DOC, "k", "rank", "next")
        again = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("of")).where("of > 1").drop("of")
        again = _renamed(again)
        ranks = saved(pairs.join(again, ["rank", "next"]).select(*DOC, "k", F.col("new").alias("rank")), "line-ranks")
        h *= 2
        if ranks.isEmpty():
            break
    if not later:
        return rows.select("doc_id", F.xxhash64("body").alias("text_hash"), F.lit(0).alias("first"),
                           F.lit(0).alias("last")).where("false")
    found = later[0]
    for more in later[1:]:
        found = found.unionByName(more)
    return _islands(found)


def _renamed(groups: DataFrame) -> DataFrame:
    """Groups of (rank, next) with their new rank as `new`."""
    order = groups.select(F.col("rank").alias("r1"), F.col("next").alias("r2"))
    return _ranked(order, "r1", "r2").select(
        F.col("r1").alias("rank"), F.col("r2").alias("next"), F.col("rank").alias("new"))


def _later_copies(blocks: DataFrame, ranks: DataFrame, level: int, h: int) -> DataFrame:
    """Blocks of h <= n < 2h lines that also occur earlier: doc, first, last."""
    head = ranks.select(*DOC, F.col("k").alias("start"), F.col("rank").alias("r1"))
    rows = blocks.join(head, [*DOC, "start"])
    if level:
        tail = ranks.select(*DOC, F.col("k").alias("end"), F.col("rank").alias("r2"))
        rows = rows.withColumn("end", (F.col("start") + F.col("n") - h).cast("int")).join(tail, [*DOC, "end"])
    else:
        rows = rows.withColumn("r2", F.col("r1"))
    place = F.struct("doc_id", "text_hash", "start")
    rows = rows.select("n", "r1", "r2", *DOC, "first", "last", place.alias("place"))
    groups = rows.groupBy("n", "r1", "r2").agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("of"))
    rows = rows.join(groups.where("of > 1").drop("of"), ["n", "r1", "r2"])
    return rows.where(F.col("place") != F.col("earliest")).select(*DOC, "first", "last")


def _islands(blocks: DataFrame) -> DataFrame:
    """Overlapping or touching blocks of a document as maximal runs."""
    doc = W.partitionBy(*DOC).orderBy("first", "last")
    reach = F.max("last").over(doc.rowsBetween(W.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0)
    rows = blocks.withColumn("new", new).withColumn("island", F.sum("new").over(doc))
    return rows.groupBy(*DOC, "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of docs with their later copies of repeated runs deleted: `text` is what is left, and n_lines,
    n_removed (lines) and runs (an array of first, last) are added.

    A null or empty text has no lines with a word and stays as it is. Rows with equal doc_id and text are
    one document and get the same result; different texts under one doc_id are ordered by their hash; rows
    without a doc_id have no place in that order: they stay as they are and count as no copy. Columns of docs
    with the added names are replaced."""
    runs = repeated_runs(docs, min_words).groupBy(*DOC).agg(
        F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))
    runs = runs.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("runs").alias("_runs"))
    rows = docs.drop("n_lines", "n_removed", "runs").withColumn("_h", F.xxhash64(body()))
    rows = rows.join(runs, (F.col("doc_id") == F.col("_id")) & (F.col("_h") == F.col("_hash")), "left")
    lines = F.split(body(), "\n", -1)
    size = F.size(lines)
    begins = F.concat(F.array(F.lit(0)), F.transform("_runs", lambda r: r["last"] + 1))
    ends = F.concat(F.transform("_runs", lambda r: r["first"]), F.array(size))
    gaps = F.arrays_zip(begins.alias("b"), ends.alias("e"))
    kept = F.array_join(F.flatten(F.transform(gaps, lambda g: F.slice("_lines", g["b"] + 1, g["e"] - g["b"]))), "\n")
    removed = F.aggregate("_runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    rows = rows.withColumn("_lines", F.when(F.col("_runs").isNotNull(), lines))
    rows = rows.select(
        *[c for c in rows.columns if c not in ("text", "_id", "_h", "_hash", "_runs", "_lines")],
        F.when(F.col("_runs").isNull(), F.col("text")).otherwise(kept).alias("text"),
        size.alias("n_lines"), F.coalesce(removed, F.lit(0)).alias("n_removed"),
        F.coalesce("_runs", F.array().cast("array<struct<first:int,last:int>>")).alias("runs"))
    return rows


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("runs", lambda r: F.concat_ws("-", r["first"], r["last"])), ",").alias("runs"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
    SELECT doc_id, ln, line, row_number() OVER d AS k, sum(w) OVER d AS upto, sum(w) OVER d - w AS before
    FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS ln FROM docs) AS x,
         LATERAL (SELECT len(regexp_extract_all(line, '{WORD}')) AS w) AS y
    WHERE w > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY ln)),
spans AS (
    SELECT doc_id, k, count(*) OVER f AS n, ln AS a, max(ln) OVER f AS z,
        max(upto) OVER (PARTITION BY doc_id) - before >= {MIN_WORDS} AS fits
    FROM lines WINDOW f AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING)
    UNION
    SELECT doc_id, k - count(*) OVER b + 1, count(*) OVER b, min(ln) OVER b, ln, upto >= {MIN_WORDS}
    FROM lines WINDOW b AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)),
blocks AS (
    SELECT s.doc_id, s.k, s.a, s.z, string_agg(l.line, chr(10) ORDER BY l.k) AS t
    FROM spans s JOIN lines l ON l.doc_id = s.doc_id AND l.k >= s.k AND l.k < s.k + s.n
    WHERE fits GROUP BY ALL),
later AS (
    SELECT doc_id, a, z FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, k) AS r FROM blocks)
    WHERE r > 1),
reach AS (SELECT *, max(z) OVER (PARTITION BY doc_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
    FROM later),
islands AS (SELECT *, sum(CASE WHEN m IS NULL OR a > m + 1 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS i FROM reach),
runs AS (SELECT doc_id, i, min(a) AS a, max(z) AS z FROM islands GROUP BY doc_id, i),
per AS (SELECT doc_id, sum(z - a + 1) AS removed, string_agg(a || '-' || z, ',' ORDER BY a) AS runs,
    list_distinct(flatten(list(range(a, z + 1)))) AS gone FROM runs GROUP BY doc_id)
SELECT doc_id, len(ls) AS n_lines, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(runs, '') AS runs,
    sha256(CASE WHEN runs IS NULL THEN array_to_string(ls, chr(10)) ELSE array_to_string(list_transform(
        list_filter(range(len(ls)), lambda i: NOT list_contains(gone, i)), lambda i: ls[i + 1]), chr(10)) END) AS kept_sha256
FROM docs LEFT JOIN per USING (doc_id)
"""
