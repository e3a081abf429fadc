"""Daily tonnage of building and disposal sites, their regions, and running totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = ["build_sum", "build_count", "disposal_sum", "disposal_count"]
SITE_KEYS = ["area_id1", "area_id2", "area_id3", "site_id", "site_name", "dept_id"]


def _site_stats(
    trips: DataFrame, flags: list[int], prefix: str, own: str, other: str, flag: str = "s_site_flag"
) -> DataFrame:
    site = {
        f"{prefix}_site_province_id": "area_id1", f"{prefix}_site_city_id": "area_id2",
        f"{prefix}_site_area_id": "area_id3", f"{prefix}_site_id": "site_id",
        f"{prefix}_site_name": "site_name",
    }
    picked = trips.where(F.col(flag).isin(flags))
    keys = [F.col(c).cast("string").alias(a) for c, a in site.items()]
    stats = picked.groupBy(*keys, "dept_id").agg(
        F.sum("load").alias(f"{own}_sum"), F.count("load").alias(f"{own}_count")
    )
    zeros = {
        f"{other}_sum": F.col(f"{own}_sum") * 0,
        f"{other}_count": (F.col(f"{own}_count") * 0).cast("long"),
    }
    return stats.withColumns(zeros).select(*SITE_KEYS, *MEASURES)


def build_stats(trips: DataFrame) -> DataFrame:
    """Tonnes and loads that left building sites (start flags 1 and 3)."""
    return _site_stats(trips, [1, 3], "s", "build", "disposal")


def disposal_stats(trips: DataFrame, flag_side: str = "start") -> DataFrame:
    """Tonnes and loads by end site of trips whose *start* flag is 2 or 4: the published
    definition of the disposal figure. ``flag_side='end'`` looks at the end flag instead."""
    flag = "s_site_flag" if flag_side == "start" else "e_site_flag"
    return _site_stats(trips, [2, 4], "e", "disposal", "build", flag)


def build_disposal_daily(trips: DataFrame) -> DataFrame:
    """Both figures in one pass: the start flag says whether a trip counts for its start or its end site."""
    build, disposal = F.col("s_site_flag").isin(1, 3), F.col("s_site_flag").isin(2, 4)
    parts = {"province_id": "area_id1", "city_id": "area_id2", "area_id": "area_id3", "id": "site_id", "name": "site_name"}
    site = [
        F.when(build, F.col(f"s_site_{part}").cast("string")).otherwise(F.col(f"e_site_{part}").cast("string")).alias(name)
        for part, name in parts.items()
    ]
    stats = trips.where(build | disposal).groupBy(build.alias("_build"), *site, "dept_id").agg(
        F.sum("load").alias("_sum"), F.count("load").alias("_count")
    )
    zero = {"sum": F.col("_sum") * 0, "count": F.lit(0).cast("long")}
    measures = [
        F.when(F.col("_build") == (own == "build"), F.col(f"_{of}")).otherwise(zero[of]).alias(f"{own}_{of}")
        for own in ("build", "disposal") for of in ("sum", "count")
    ]
    return stats.select(*SITE_KEYS, *measures)


def _sums() -> list:
    return [F.sum(m).alias(m) for m in MEASURES]


def area_rollup(daily: DataFrame, area_names: DataFrame) -> DataFrame:
    """Totals by province, city and area in one pass; blank area ids do not count."""
    levels = F.explode(
        F.array(*[F.struct(F.lit(i).alias("level"), F.col(f"area_id{i}").alias("id")) for i in (1, 2, 3)])
    )
    long = daily.withColumn("_l", levels).where(F.col("_l.id").isNotNull() & (F.col("_l.id") != ""))
    totals = long.groupBy(F.col("_l.level").alias("level"), F.col("_l.id").alias("site_id"), "dept_id").agg(*_sums())
    names = area_names.select(F.col("id").alias("site_id"), F.col("area_name").alias("site_name"))
    return totals.join(names, "site_id", "left").select(
        "level", "site_id", "site_name", "dept_id", *MEASURES
    )


def site_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy("site_id", "site_name", "dept_id").agg(*_sums())


def cumulative_amount(daily: DataFrame, area_names: DataFrame, before: DataFrame) -> DataFrame:
    """Yesterday's running totals plus the totals of the day, by (site, name, department). Sites and the three
    levels of area are summed in one pass over the day."""
    columns = ["site_id", "site_name", "dept_id", *MEASURES]
    none = F.lit(None).cast("string")
    levels = F.array(
        F.struct(F.lit(True).alias("site"), F.col("site_id").alias("id"), F.col("site_name").alias("name")),
        *[F.struct(F.lit(False).alias("site"), F.col(f"area_id{i}").alias("id"), none.alias("name")) for i in (1, 2, 3)],
    )
    long = daily.withColumn("_l", F.explode(levels)).where(F.col("_l.site") | (F.col("_l.id") != ""))
    totals = long.groupBy("_l.site", "_l.id", "_l.name", "dept_id").agg(*_sums())
    names = area_names.select(F.lit(False).alias("site"), "id", "area_name")
    today = totals.join(names, ["site", "id"], "left").withColumns(
        {"site_id": F.col("id"), "site_name": F.when(F.col("site"), F.col("name")).otherwise(F.col("area_name"))}
    ).select(*columns)
    return today.unionByName(before.select(*columns)).groupBy("site_id", "site_name", "dept_id").agg(*_sums())
