"""Near-duplicates by min-max hashing: both the least and the greatest value of a permutation are kept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.llm.common import body, documents, hold, in_slices, saved
from haulwatch.llm.components import components

#: Links need this similarity (intersection by union), in percent.
LINKED_PCT = 80
#: Signature: BANDS bands of ROWS values; half the values are minima, half maxima of one permutation each.
#: Two documents of similarity 0.8 share a band but for 3 pairs in 10^9, (1 - 0.8^5)^50.
BANDS = 50
ROWS = 5
#: Words whose hash a Python worker remembers.
REMEMBERED = 150_000
#: Shingles hashed or compared at once.
STRETCH = 4096
#: Sets on either side of a block that is compared in one task, and their shingles.
BLOCK = 512
BLOCK_SHINGLES = 500_000

_SEED = 1_592_653
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_PERMUTATIONS = np.random.default_rng(_SEED).integers(0, 2**64, (BANDS * ROWS) // 2, np.uint64) | np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[2]
    return x ^ (x >> np.uint64(29))


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit numbers: `width` words each, or all words if they
    are fewer; none without words. A-Z are lower-cased, words end at ASCII blanks."""
    words = text.encode().lower().split()
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    take = min(width, len(words))
    if not take:
        return hashes
    x = np.full(len(words) - take + 1, take, np.uint64)
    for i in range(take):
        x = _mixed(x * _MIX[0] + hashes[i:len(words) - take + 1 + i] * _MIX[1])
    return np.unique(x)


def signature(x: np.ndarray) -> np.ndarray:
    """One number per band of the shingles x."""
    low = np.full(len(_PERMUTATIONS), 2**64 - 1, np.uint64)
    high = np.zeros(len(_PERMUTATIONS), np.uint64)
    for at in range(0, len(x), STRETCH):
        values = _PERMUTATIONS[:, None] * x[None, at:at + STRETCH]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    # a band holds minima or maxima of different permutations, which are independent
    rows = np.concatenate((low, high)).reshape(BANDS, ROWS)
    band = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        band = _mixed(band * _MIX[0] + rows[:, i] * _MIX[1])
    return band.view(np.int64)


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n (shingles), key (128 bits of the set), bands of each row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("near_dedup", _WORDS.clear)
        sets = [shingles(text, width) for text in batch.column("body").to_pylist()]
        keys = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
        bands = [signature(x) if len(x) else [] for x in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "key", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", body().alias("body"))
    return in_slices(rows, run, f"doc_id {kind}, n long, key binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node, n, shingles of the classes in wanted(node, rep, key), from the text of their representative."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(text, width) for text in batch["body"]]
            # another text under the same id is not the representative
            right = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() == key for x, key in zip(sets, batch["key"])]
            yield pd.DataFrame({
                "node": batch["node"], "n": [len(x) for x in sets],
                "shingles": [x.view(np.int64) for x in sets]})[np.asarray(right, bool)]

    rows = docs.select("doc_id", body().alias("body")).join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")))
    rows = rows.select("node", "key", "body").mapInPandas(run, "node long, n long, shingles array<long>")
    return rows.dropDuplicates(["node"])


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b) with the sizes of intersection and union of their full sets, `both` and `any`."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    rows = pairs.join(left, "a").join(right, "b")
    rows = rows.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("s_a", "s_b")).cast("long").alias("both"))
    return rows.select("a", "b", "both", (F.col("n_a") + F.col("n_b") - F.col("both")).alias("any"))


def _linked(pct: int) -> Column:
    return 100 * F.col("both") >= pct * F.col("any")


def _buckets(classes: DataFrame) -> DataFrame:
    """h, hub, node, n of the classes that share a band with another one. The hub of a bucket is the member that shares
    bands with the most classes in all, so that a text with many altered copies is the hub of most of them."""
    rows = classes.select("node", "n", F.explode("bands").alias("h"))
    # sums are tables of their own, so that Spark can split the rows of a hot bucket between tasks of a join
    often = saved(rows.groupBy("h").agg(F.count(F.lit(1)).alias("of")).where("of > 1"), "often")
    rows = saved(rows.join(often, "h"), "buckets")
    rows = rows.join(rows.groupBy("node").agg(F.sum("of").alias("met")), "node")
    hubs = rows.groupBy("h").agg(F.max(F.struct("met", (-F.col("node")).alias("node"))).alias("best"))
    hubs = saved(hubs.select("h", (-F.col("best.node")).alias("hub")), "hubs")
    return rows.join(hubs, "h").select("h", "hub", "node", "n")


def _block_links(group: pd.DataFrame, pct: int) -> pd.DataFrame:
    """Links between the two sides of a block, of different labels, by the exact intersections of their sets. Columns
    of the tables are the shingles that both sides have, some at a time."""
    one, two = (group[group["side"] == i] for i in (0, 1))
    sets = [[np.asarray(x, np.int64) for x in part["shingles"]] for part in (one, two)]
    if not len(one) or not len(two):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    shared = np.intersect1d(np.concatenate(sets[0]), np.concatenate(sets[1]))
    both = np.zeros((len(one), len(two)), np.float32)
    places = []
    for part in sets:
        row = np.repeat(np.arange(len(part)), [len(x) for x in part])
        values = np.concatenate(part)
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        hit = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        places.append((row[hit], at[hit]))
    for first in range(0, len(shared), STRETCH):
        tables = []
        for (row, at), part in zip(places, sets):
            here = (at >= first) & (at < first + STRETCH)
            table = np.zeros((len(part), STRETCH), np.float32)
            table[row[here], at[here] - first] = 1
            tables.append(table)
        both += tables[0] @ tables[1].T
    n_one, n_two = (part["n"].to_numpy() for part in (one, two))
    union = n_one[:, None] + n_two[None, :] - both
    linked = (100 * both >= pct * union) & (one["label"].to_numpy()[:, None] != two["label"].to_numpy()[None, :])
    x, y = np.nonzero(linked)
    return pd.DataFrame({"a": one["node"].to_numpy()[x], "b": two["node"].to_numpy()[y]})


def _other_links(members: DataFrame, sets: DataFrame, labels: DataFrame, pct: int) -> DataFrame:
    """Links (a, b) between members of a bucket that are in different components so far. One of them is then not in
    the component of its hub. These are compared with all members that share the hub, in blocks of some BLOCK sets and
    BLOCK_SHINGLES shingles a side, so that a task holds two blocks whatever the size of the group, and only links come
    out of it."""
    label = labels.select("node", "label")
    rows = members.where("node <> hub").select("hub", "node", "n").distinct().join(label, "node", "left")
    rows = rows.withColumn("label", F.coalesce("label", "node"))
    hubs = label.select(F.col("node").alias("hub"), F.col("label").alias("hub_label"))
    rows = rows.join(hubs, "hub", "left").withColumn("out", F.col("label") != F.coalesce("hub_label", "hub"))
    sizes = rows.groupBy("hub").agg(
        F.count_if("out").alias("outs"), F.count(F.lit(1)).alias("all"),
        F.coalesce(F.sum(F.when(F.col("out"), F.col("n"))), F.lit(0)).alias("outs_n"), F.sum("n").alias("all_n"),
    ).where("outs > 0")
    sizes = saved(sizes, "hub-sizes")
    rows = saved(rows.join(sizes, "hub").select("hub", "node", "label", "out", *[
        F.ceil(F.greatest(F.col(c) / BLOCK, F.col(f"{c}_n") / BLOCK_SHINGLES)).alias(c) for c in ("outs", "all")]),
        "mixed-buckets")
    spread = F.xxhash64("node", "hub")
    one = rows.where("out").select(
        "hub", "node", "label", F.lit(0).alias("side"), F.pmod(spread, F.col("outs")).alias("x"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1)).alias("y"))
    two = rows.select(
        "hub", "node", "label", F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("outs") - 1)).alias("x"),
        F.pmod(spread, F.col("all")).alias("y"))
    blocks = one.unionByName(two).join(sets, "node")
    links = blocks.groupBy("hub", "x", "y").applyInPandas(lambda group: _block_links(group, pct), "a long, b long")
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, pct: int = LINKED_PCT) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents with the same set are one class, whatever their number; the rest works on one representative
    per class. Its signature is cut into bands; classes with an equal band share a bucket. In each bucket the
    full sets of all members are compared with that of one of them, the hub, so that a bucket costs as many
    comparisons as members; links give components. Members left outside the component of their hub are then
    compared with the others in blocks: no link that shares a band is lost, and no bucket gives all its pairs.
    component_id is the smallest doc_id of the component, kept says that the row bears it.

    A text without words, also a null one, is linked with nothing and kept. A null doc_id is never the
    smallest unless there is no other; rows that repeat a doc_id and text share their result. Other columns are
    ignored; an empty table gives no rows."""
    if Fraction(pct, 100) < Fraction(4, 5):
        raise ValueError("the bands are made for similarities of 0.8 and more")
    signed = saved(_signed(docs, width), "signatures")
    classes = signed.where("n > 0").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = saved(_buckets(classes), "members")
    stars = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    wanted = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = wanted.join(classes.select("node", "rep", "key"), "node")
    sets = saved(_sets(docs, wanted, width), "sets")
    similar = saved(_similar(stars, sets), "similar")
    links = similar.where(_linked(pct)).select("a", "b")
    labels = saved(components(links), "labels")
    more = saved(_other_links(members, sets, labels, pct), "other-links")
    if not more.isEmpty():
        labels = saved(components(links.unionByName(more)), "labels")
    found = classes.select("key", "rep", "node").join(labels, "node", "left")
    found = found.withColumn("label", F.coalesce("label", "node"))
    least = found.groupBy("label").agg(F.min("rep").alias("component_id"))
    found = found.join(least, "label").select("key", "component_id")
    out = signed.select("doc_id", "n", "key").join(found, "key", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))


def op8_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=2)
