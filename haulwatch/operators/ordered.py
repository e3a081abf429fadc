"""Ordered logic per vehicle that does not put a vehicle into one task.

Rows of a key are cut into chunks of time and sorted inside (key, chunk). What one chunk has to
know of another is carried by its edge rows only, a handful per chunk, which are the only rows
that are ever brought together by key alone. A vehicle that holds a large part of all rows is
so spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwatch.session import dealt

DAY = 86400


def timed(df: DataFrame, order: tuple[str, ...] = ("t_sec", "event_id")) -> DataFrame:
    """Rows that have a place in the order. Ordered operators work on these; see :func:`untimed`."""
    return df.dropna(subset=list(order))


def untimed(df: DataFrame, order: tuple[str, ...] = ("t_sec", "event_id")) -> DataFrame:
    """The rows that :func:`timed` leaves out, for a reject table: their message bore no valid date."""
    missing = F.lit(False)
    for column in order:
        missing = missing | F.col(column).isNull()
    return df.where(missing)


def with_chunk(df: DataFrame, width: int = DAY, sec: str = "t_sec") -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.col(sec) / width))


def with_neighbours(
    df: DataFrame, keys: list[str], payload: list[str], width: int = DAY,
    order: tuple[str, str] = ("t_sec", "event_id"),
) -> DataFrame:
    """Adds structs ``prev`` and ``next``: ``payload`` of the row before and after in the
    key's order, null at its ends. Rows without a time are left out."""
    rows = dealt(with_chunk(timed(df, order), width, order[0]), *keys, "_chunk")
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    near = F.struct(*payload)
    rows = rows.withColumns({"prev": F.lag(near).over(inside), "next": F.lead(near).over(inside)})
    edge = F.col("prev").isNull() | F.col("next").isNull()
    # Of every chunk only its first and last row reach this window.
    across = Window.partitionBy(*keys).orderBy(*order)
    edges = dealt(rows.where(edge), *keys).withColumns(
        {
            "prev": F.coalesce("prev", F.lag(near).over(across)),
            "next": F.coalesce("next", F.lead(near).over(across)),
        }
    )
    return rows.where(~edge).unionByName(edges).drop("_chunk")


def episodes(
    df: DataFrame, keys: list[str], opens: Column, closes: Column, payload: list[str],
    by: list[str] | None = None, pick: str = "first", width: int = DAY,
    order: tuple[str, str] = ("t_sec", "event_id"),
) -> DataFrame:
    """Pairs opening rows with the next closing row of their key.

    All opening rows between two closing rows form one episode per value of ``by``; ``opened``
    is its first (or last) opening row, ``closed`` the closing row, both as structs of the order
    columns and ``payload``. A row that both opens and closes belongs to the episode it closes.
    Episodes without a closing row are not returned; rows without a time are left out."""
    df = timed(df, order)
    by = by or []
    best = F.min if pick == "first" else F.max
    mark = F.explode(
        F.filter(
            F.array(F.when(opens, F.lit(0)), F.when(closes, F.lit(1))), lambda m: m.isNotNull()
        )
    )
    rows = with_chunk(df, width, order[0]).select(
        *keys, "_chunk", *by, F.struct(*order, *payload).alias("_p"), mark.alias("_m")
    )
    is_close = F.col("_m") == 1
    latest_first = Window.partitionBy(*keys, "_chunk").orderBy(
        *[F.col("_p")[c].desc() for c in order], F.col("_m").desc()
    )
    so_far = latest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns(
        {
            "_close": F.last(F.when(is_close, F.col("_p")), ignorenulls=True).over(so_far),
            "_before": F.lead("_m").over(latest_first),
        }
    )
    # A closing row right after another one closes nothing, unless it is first in its chunk.
    rows = rows.where(~is_close | F.col("_before").isNull() | (F.col("_before") == 0))
    pieces = rows.groupBy(*keys, "_chunk", *by, "_close").agg(
        best(F.when(~is_close, F.col("_p"))).alias("_open")
    )
    first_close = F.min("_close").over(Window.partitionBy(*keys, "_chunk"))
    pieces = pieces.withColumn(
        "_edge", F.col("_close").isNull() | F.coalesce(F.col("_close") == first_close, F.lit(False))
    )
    # Open ends of a chunk look for the first closing row of a later chunk.
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_chunk").desc(), F.col("_close").isNull().desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    edges = pieces.where("_edge").withColumn("_close", F.last("_close", ignorenulls=True).over(later))
    done = pieces.where(~F.col("_edge")).unionByName(edges)
    done = done.where(F.col("_open").isNotNull() & F.col("_close").isNotNull())
    return done.groupBy(*keys, *by, F.col("_close").alias("closed")).agg(best("_open").alias("opened"))
