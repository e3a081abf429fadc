"""Ranks inside a key, without one task per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulwatch.session import stored


def with_place(rows: DataFrame, keys: list[str], score: str, place: str = "place") -> DataFrame:
    """Adds the rank of a row in its key by score, highest first, null last; equal scores share a rank and count as
    many as they are.

    Distinct scores, counted on the map side, are dealt to ranges of (key, score) of about equal size, whatever the
    distribution of the scores, and sorted there. A score's rank is one more than the rows of the ranges before its own
    and those before it in its range. The ranges are stored, so that both sums speak of the same ones."""
    values = rows.groupBy(*keys, score).agg(F.count(F.lit(1)).alias("_n"))
    highest_first = F.col(score).desc_nulls_last()
    dealt = values.repartitionByRange(*[F.col(k) for k in keys], highest_first)
    dealt = stored(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    ranges = dealt.groupBy(*keys, "_range").agg(F.sum("_n").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_of"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_range").orderBy(highest_first).rowsBetween(Window.unboundedPreceding, -1)
    found = dealt.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    own = F.col("_range") == F.col("_of")
    for key in keys:
        own = own & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    found = found.join(ranges, own).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col(score).alias("_score"),
        (F.col("_before") + F.col("_inside") + 1).cast("int").alias(place))
    same = F.col(score).eqNullSafe(F.col("_score"))
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return rows.join(found, same).drop("_score", *[f"_k_{k}" for k in keys])
