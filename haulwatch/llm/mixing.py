"""Mixing sources to target weights: a splitting tree deals exact quotas of source blocks to output shards."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haulwatch.llm.common import WORD, body, documents, saved, small_table

# Fixed values of the mix.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = 20_240_115
#: Documents of a block, on average, and blocks of an output shard.
BLOCK_DOCS = 64
SHARD_BLOCKS = 256
#: Blocks of a source whose sums are taken by one task.
SEGMENT_BLOCKS = 1024
#: Orders that are tried to fill the last block of a source.
TRIES = 64
#: Sources are listed on the driver; more of them end the job.
MOST_SOURCES = 100_000


@dataclass(frozen=True)
class Source:
    sid: int
    name: str | None
    size: int
    rows: int
    target: Fraction = Fraction(0)
    quota: int = 0

    @property
    def copies(self) -> int:
        """Whole copies of the source in the mix."""
        return int(self.target // self.size) if self.size else 0

    @property
    def rest(self) -> int:
        """Words of a last, partial copy."""
        return round(self.target - self.copies * self.size)

    @property
    def blocks(self) -> int:
        return max(1, -(-self.rows // BLOCK_DOCS))


def with_targets(sources: list[Source], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> list[Source]:
    """Sources in code point order, null last, with their part of all words: by weight, at most `most` times
    their size, the excess shared again by weight. Exact fractions."""
    order = sorted(sources, key=lambda s: (s.name is None, s.name or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = Fraction(sum(s.size for s in order)), list(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > most * s.size]
        for s in full or open_:
            target[s] = Fraction(most * s.size) if full else share * weight[s]
            left -= target[s]
        open_ = [s for s in open_ if s not in target]
    return [replace(s, sid=i, target=target[s]) for i, s in enumerate(order)]


class SplittingTree:
    """Deals `quotas` (blocks per source) to shards. A node covers a range of shards; its left half gets a
    multivariate hypergeometric draw of the node's blocks, as many as its shards hold. Draws depend on the
    seed and the node alone, so that any task can walk to any shard without the others."""

    def __init__(self, quotas: list[int], shards: int, seed: int):
        self.quotas, self.shards, self.seed = np.asarray(quotas, np.int64), shards, seed
        self.total = int(self.quotas.sum())

    def _share(self, first: int, last: int) -> int:
        """Blocks that the shards first..last-1 hold."""
        return self.total * last // self.shards - self.total * first // self.shards

    def shard_of(self, source: np.ndarray, index: np.ndarray) -> np.ndarray:
        """The shard of the index-th block of a source: shards take consecutive blocks of its permuted list."""
        out = np.zeros(len(source), np.int64)
        todo = [(0, self.shards, self.quotas, np.arange(len(source)), index.astype(np.int64))]
        while todo:
            first, last, quotas, rows, at = todo.pop()
            if last - first == 1:
                out[rows] = first
                continue
            half = (first + last) // 2
            draw = np.random.default_rng((self.seed, first, last))
            left = draw.multivariate_hypergeometric(quotas, self._share(first, half), method="marginals")
            goes = at < left[source[rows]]
            for a, b, q, mine, base in ((first, half, left, goes, 0), (half, last, quotas - left, ~goes, left)):
                if mine.any():
                    inner = rows[mine]
                    shift = base[source[inner]] if isinstance(base, np.ndarray) else 0
                    todo.append((a, b, q, inner, at[mine] - shift))
        return out


def _sources(rows: DataFrame) -> list[Source]:
    found = rows.groupBy("_source").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows"))
    found = found.limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    return with_targets([Source(i, r["_source"], r["size"], r["rows"]) for i, r in enumerate(found)])


def _draw(*of: str | Column) -> Column:
    return F.xxhash64(F.lit(SEED), *of)


def _drawn_blocks(blocks: DataFrame, sources: list[Source]) -> DataFrame:
    """Blocks of each copy of a source in permuted order, as far as the mix takes them: _sid, _block, copy, index
    (place in the list of all copies), part (the words that a block at the edge still gives, else null)."""
    spark = blocks.sparkSession
    plan = small_table(
        spark, [(s.sid, s.copies, s.rest, s.blocks) for s in sources], "_sid int, copies int, rest long, planned long")
    rows = blocks.join(plan, "_sid").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("copies")))).where("copy < copies OR rest > 0")
    # the order of a copy is that of a hash; a segment is a range of hashes
    rows = rows.withColumn("u", _draw("_sid", "copy", "_block"))
    rows = rows.withColumn("segment", F.floor(
        (F.col("u") / F.lit(2.0**64) + 0.5) * F.ceil(F.col("planned") / SEGMENT_BLOCKS)))
    copy = ["_sid", "copy"]
    earlier = W.partitionBy(*copy).orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    segments = rows.groupBy(*copy, "segment").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("of"))
    segments = segments.select(
        *copy, "segment", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("of").over(earlier), F.lit(0)).alias("of_before"))
    inside = W.partitionBy(*copy, "segment").orderBy("u", "_block").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("place", F.count(F.lit(1)).over(inside)).withColumn("sum", F.sum("words").over(inside))
    rows = rows.join(segments, [*copy, "segment"])
    upto = F.col("of_before") + F.col("sum")
    before = upto - F.col("words")
    whole = (F.col("copy") < F.col("copies")) | (upto <= F.col("rest"))
    rows = rows.where(whole | (before < F.col("rest")))
    index = F.col("copy") * F.col("of_copy") + F.col("n_before") + F.col("place") - 1
    return rows.select(
        "_sid", "_block", "copy", index.alias("index"), F.when(~whole, F.col("rest") - before).alias("part"))


def fitting(sizes: np.ndarray, room: int, seed: int) -> np.ndarray:
    """Which of the sizes to take: in a random order each that still fits; of TRIES orders the one that fills best."""
    best, left = np.zeros(len(sizes), bool), room
    for order in (np.random.default_rng((seed, t)).permutation(len(sizes)) for t in range(TRIES)):
        take, rest = np.zeros(len(sizes), bool), room
        for i in order:
            if 0 < sizes[i] <= rest:
                take[i], rest = True, rest - sizes[i]
        if rest < left:
            best, left = take, rest
    return best


def _fill(rows: DataFrame) -> DataFrame:
    """Of a block at the edge of a source, some BLOCK_DOCS documents, those that fill its part."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_order", "_size"], kind="stable")
        return group[fitting(group["_size"].to_numpy(), int(group["_part"].iloc[0]), SEED)]

    return rows.groupBy("_sid").applyInPandas(run, rows.schema)


def mixed(docs: DataFrame) -> tuple[DataFrame, list[Source], DataFrame]:
    """The mix of docs(doc_id, text, source, ...): a row for each copy of a document that is drawn, with the
    columns of docs and _size (words), _sid, _copy, _shard, _order (place inside the shard, by a hash); the
    sources; and all rows of docs with _size and _sid.

    Documents fall into blocks of some BLOCK_DOCS by a hash. Each copy of a source is a permuted list of
    its blocks; the mix takes whole copies and then blocks up to the target, of the last block the documents
    that fill it best, so that a source misses its target by less than its smallest document left out there. The
    lists, end to end, are dealt to the shards by the splitting tree. Draws are hashes: reruns agree.

    A null text has no words, a null source is a source of its own, last in order. Documents without words weigh
    nothing and come with their block. Equal rows are drawn alike, each for itself. An empty table gives none."""
    size = F.regexp_count(body(), F.lit(WORD)).cast("long")
    rows = docs.withColumn("_source", F.col("source").cast("string")).withColumn("_size", size)
    sources = _sources(rows.select("_source", "_size"))
    spark = docs.sparkSession
    table = small_table(
        spark, [(s.sid, s.name, s.blocks) for s in sources], "_sid int, _name string, _blocks long")
    rows = rows.join(table, F.col("_source").eqNullSafe(F.col("_name")), "left").drop("_name", "_source")
    key = _draw("doc_id", "_size")
    rows = rows.withColumn("_block", F.pmod(key, F.col("_blocks"))).drop("_blocks")
    blocks = rows.groupBy("_sid", "_block").agg(F.sum("_size").alias("words"))
    blocks = saved(blocks, "mix-blocks")
    of_copy = blocks.groupBy("_sid").agg(F.count(F.lit(1)).alias("of_copy"))
    drawn = saved(_drawn_blocks(blocks.join(of_copy, "_sid"), sources), "mix-drawn")
    quota = {r["_sid"]: r["n"] for r in drawn.groupBy("_sid").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(quota.values())
    sources = [replace(s, quota=quota.get(s.sid, 0)) for s in sources]
    tree = SplittingTree([s.quota for s in sources], max(1, -(-total // SHARD_BLOCKS)), SEED)

    @F.pandas_udf("long")
    def shard(source: pd.Series, index: pd.Series) -> pd.Series:
        return pd.Series(tree.shard_of(source.to_numpy(), index.to_numpy()))

    drawn = drawn.select("_sid", "_block", F.col("copy").alias("_copy"), shard("_sid", "index").alias("_shard"),
                         F.col("part").alias("_part"))
    out = rows.join(drawn, ["_sid", "_block"]).withColumn("_order", _draw("_shard", "_copy", "doc_id", "_size"))
    whole = out.where("_part IS NULL")
    edge = _fill(out.where("_part IS NOT NULL"))
    return whole.unionByName(edge).drop("_part", "_block"), sources, rows.drop("_block")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: documents as often as they are drawn, shard by shard, shuffled inside a shard."""
    out, _, _ = mixed(docs)
    return out.repartition("_shard").sortWithinPartitions("_shard", "_order").select(*docs.columns)


def taken_words(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken, shards (how many have it). Rows with the
    same doc_id, source and size share what the mix takes of them in equal parts."""
    out, sources, rows = mixed(docs.select("doc_id", "text", "source"))
    taken = out.groupBy(F.col("doc_id").alias("_id"), F.col("_size").alias("_of"), F.col("_sid").alias("_s")).agg(
        F.sum("_size").alias("_taken"), F.countDistinct("_shard").alias("_shards"))
    key = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_size") == F.col("_of")) & (F.col("_sid") == F.col("_s"))
    rows = rows.select("doc_id", "_size", "_sid").groupBy("doc_id", "_size", "_sid").agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(taken, key, "left")
    totals = [(s.sid, s.size, float(s.target)) for s in sources]
    totals = small_table(docs.sparkSession, totals, "_sid int, source_size long, target double")
    each = F.transform(F.sequence(F.lit(1), F.col("_n")), lambda i: (
        F.floor(F.col("_taken") * i / F.col("_n")) - F.floor(F.col("_taken") * (i - 1) / F.col("_n"))))
    rows = rows.join(totals, "_sid").withColumn("_each", F.explode(each))
    return rows.select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        F.coalesce("_each", F.lit(0)).cast("long").alias("taken"), F.coalesce("_shards", F.lit(0)).alias("shards"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(documents(spark, sf_dir))
