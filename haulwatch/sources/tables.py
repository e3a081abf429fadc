"""Dimension tables and partitioned tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, user: str | None = None,
    password: str | None = None, driver: str | None = None, partition_column: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 1, fetch_rows: int = 10000,
) -> DataFrame:
    """Full scan of a database table; with a partition column the scan runs in parallel.
    Filters and column lists placed on the result are pushed to the database by Spark."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            reader = reader.option(key, value)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.option("fetchsize", fetch_rows).load()


def day_partition(as_of: dt.date, offset_days: int = 0) -> dict[str, str]:
    """Partition values of a day, by default of ``as_of`` itself."""
    day = as_of + dt.timedelta(days=offset_days)
    return {"month_id": day.strftime("%Y-%m"), "day_id": str(day.day)}


def one_partition(df: DataFrame, as_of: dt.date, offset_days: int = -1) -> DataFrame:
    """Rows of one day partition, by default of yesterday; only its files are listed."""
    values = day_partition(as_of, offset_days)
    month, day = F.col("month_id"), F.col("day_id")
    return df.where((month == values["month_id"]) & (day == values["day_id"]))


def latest_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the last in ``order``. An aggregate with map-side combine, so a key
    with very many rows is reduced before it is shuffled."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order)
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
