"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwatch.llm.common import replaced, saved_at


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Each node hands the least node it sees (itself included) to its larger neighbours (large star), or
    to its smaller ones and itself (small star)."""
    flipped = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    seen = links.unionByName(flipped) if large else links
    least = seen.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("least", "a").alias("least"))
    out = seen.join(least, F.col("a") == F.col("node"))
    if large:
        return out.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    return out.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own)


def components(links: DataFrame) -> DataFrame:
    """node, label (the least node of its component) of every node of links(a, b), of numbers.

    Large and small stars alternate until the links are stars around the least nodes; sums and joins run by
    node, and a node with many links is summed on the map side. Loops and repeated links do no harm, nulls are left
    out, and a table without links gives no rows."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    (links, path), before = saved_at(links, "links"), None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        for large in (True, False):
            links = _stars(links, large).where("a <> b").distinct()
        links, path = replaced(links, "links", path)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
