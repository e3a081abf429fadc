"""As-of joins: each row with the version that was valid at its time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulwatch.operators.ordered import DAY


def as_of(
    rows: DataFrame, versions: DataFrame, keys: list[str], time: str = "t_sec", valid_from: str = "valid_from",
    valid_to: str | None = None, width: int = DAY,
) -> DataFrame:
    """``rows`` with the columns of the version of their key that holds at their time: the one with the latest
    ``valid_from`` not after it, unless it ended, ``valid_to`` being its first second without. Null columns if there is
    none, or if the row has no key or time. Of versions with the same start the largest row holds.

    Rows and versions are merged in chunks of time and sorted there, so that a key with most of the rows is spread over
    its chunks. What holds when a chunk begins is carried from the chunks before: per key this takes one row for each
    chunk that it occurs in. No row is paired with the versions it does not need."""
    attrs = [c for c in versions.columns if c not in (*keys, valid_from)]
    order = [valid_from, *attrs]
    known = versions.dropna(subset=[*keys, valid_from]).select(
        *keys, F.col(valid_from).alias("_t"), F.struct(*order).alias("_version"))
    chunk = F.floor(F.col("_t") / width).alias("_chunk")
    known = known.select("*", chunk)
    columns = [c for c in rows.columns if c not in keys]
    clash = set(columns) & set(attrs)
    if clash:
        raise ValueError(f"rows and versions share the columns {sorted(clash)}")
    placed = F.col(time).isNotNull()
    for key in keys:
        placed = placed & F.col(key).isNotNull()
    timed = rows.where(placed).select(*keys, F.col(time).alias("_t"), F.struct(*columns).alias("_row"))
    timed = timed.select("*", chunk)
    merged = timed.withColumn("_version", F.lit(None).cast(known.schema["_version"].dataType)).unionByName(
        known.withColumn("_row", F.lit(None).cast(timed.schema["_row"].dataType)))
    # at the same second a version comes before the rows, and of several versions the largest last
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_t", F.col("_row").isNotNull(), "_version").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = merged.withColumn("_here", F.last("_version", ignorenulls=True).over(inside)).where(F.col("_row").isNotNull())
    last = merged.groupBy(*keys, "_chunk").agg(F.max("_version").alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_before", F.last("_last", ignorenulls=True).over(across)).drop("_last")
    out = found.join(carried.where(F.col("_before").isNotNull()), [*keys, "_chunk"], "left")
    held = F.coalesce("_here", "_before")
    if valid_to is not None:
        ends = held[valid_to]
        held = F.when(ends.isNull() | (F.col("_t") < ends), held)
    out = out.withColumn("_held", held).select(
        *keys, "_row.*", F.col(f"_held.{valid_from}").alias(valid_from), *[F.col(f"_held.{c}").alias(c) for c in attrs])
    unplaced = rows.where(~placed).select(*keys, *columns, *[
        F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in order])
    return out.unionByName(unplaced)
