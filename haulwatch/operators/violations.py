"""Violation counts and scores by type, enterprise, vehicle and region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwatch.operators.ranking import with_place
from haulwatch.session import dealt

REGION = ["dept_id", "province_id", "city_id", "area_id"]
ENTERPRISE = ["transport_enterprise_id", "enterprise_name"]
VEHICLE = ["vehicle_id", "car_card_number"]
TYPE = ["illegal_id", "illegal_name"]

# Score columns by violation code.
SCORE_CODES = {
    "alarm_speed": "0110", "alarm_out": "0108", "alarm_dump": "0121", "alarm_offline": "0107",
}


def scoring_detail(detail: DataFrame) -> DataFrame:
    """The detail rows the counts are made from. ``illegal_id`` is a violation code."""
    return detail.select(
        "vehicle_id", "car_card_number", "enterprise_name", "illegal_id",
        "enterprise_final_score", "vehicle_driver_final_score",
        F.col("enterprise_id").alias("transport_enterprise_id"), "province_id", "city_id", "area_id",
        F.col("illegal_type_short_desc").alias("illegal_name"),
        F.col("create_time").alias("illegal_date"), F.col("create_time").alias("create_date"), "dept_id",
    )


def _count(distinct: bool, score: str) -> list:
    out = [F.count_distinct("vehicle_id").alias("illegal_vehicle_count")] if distinct else []
    return [*out, F.count(F.lit(1)).alias("illegal_count"), F.sum(score).alias("illegal_sum")]


def rank_by_type(df: DataFrame) -> DataFrame:
    return df.groupBy(*REGION, *TYPE).agg(*_count(True, "vehicle_driver_final_score"))


def rank_by_enterprise(df: DataFrame) -> DataFrame:
    return df.groupBy(*REGION, *ENTERPRISE).agg(*_count(True, "enterprise_final_score"))


def rank_by_enterprise_type(df: DataFrame) -> DataFrame:
    return df.groupBy(*REGION, *ENTERPRISE, *TYPE).agg(*_count(False, "enterprise_final_score"))


def rank_by_vehicle(df: DataFrame) -> DataFrame:
    return df.groupBy(*REGION, *VEHICLE).agg(*_count(False, "vehicle_driver_final_score"))


def rank_by_vehicle_type(df: DataFrame) -> DataFrame:
    """The vehicle is part of the key, so its distinct count is 1, or 0 for a null vehicle."""
    return df.groupBy(*REGION, *VEHICLE, *TYPE).agg(
        F.when(F.col("vehicle_id").isNull(), 0).otherwise(1).cast("long").alias("illegal_vehicle_count"),
        *_count(False, "vehicle_driver_final_score"),
    )


def rank_total(df: DataFrame) -> DataFrame:
    return df.groupBy(*REGION).agg(*_count(False, "vehicle_driver_final_score"))


def score_pivot(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    """One score column per violation code and their total."""
    parts = {
        name: F.sum(F.when(F.col("illegal_id") == code, F.col(score)).otherwise(0.0))
        for name, code in SCORE_CODES.items()
    }
    pivoted = df.groupBy(*keys).agg(*[column.alias(name) for name, column in parts.items()])
    names = list(parts)
    total = F.col(names[0])
    for name in names[1:]:
        total = total + F.col(name)
    return pivoted.withColumn("total_score", total)


def score_pivot_region_vehicle(df: DataFrame) -> DataFrame:
    return score_pivot(df, REGION, "vehicle_driver_final_score")


def score_pivot_vehicle(df: DataFrame) -> DataFrame:
    return score_pivot(df, [*REGION, *VEHICLE, "transport_enterprise_id"], "vehicle_driver_final_score")


def score_pivot_region_enterprise(df: DataFrame) -> DataFrame:
    return score_pivot(df, REGION, "enterprise_final_score")


def score_pivot_enterprise(df: DataFrame) -> DataFrame:
    return score_pivot(df, [*REGION, *ENTERPRISE], "enterprise_final_score")


# name -> keys beyond the region
RANK_LEVELS = {
    "type": TYPE, "enterprise": ENTERPRISE, "enterprise_type": [*ENTERPRISE, *TYPE],
    "vehicle": VEHICLE, "vehicle_type": [*VEHICLE, *TYPE], "total": [],
}


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("illegal_count").alias("illegal_count"), F.sum("illegal_sum").alias("illegal_sum"))


def _with_vehicles(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and sums per key, and the distinct vehicles: summed per vehicle first, so that each is one row."""
    return _summed(rows, [*keys, "vehicle_id"]).groupBy(*keys).agg(
        F.count("vehicle_id").alias("illegal_vehicle_count"), F.sum("illegal_count").alias("illegal_count"),
        F.sum("illegal_sum").alias("illegal_sum"))


def rank_grouping_sets(df: DataFrame) -> DataFrame:
    """All six rank tables in one plan; ``level`` names the table a row belongs to.

    The levels of vehicles follow from each other, those of enterprises too; the detail is shuffled once for either, by
    what its levels have in common, and with their columns only."""
    def counted(score: str, keys: list[str]) -> DataFrame:
        return df.select(*REGION, *keys, F.lit(1).cast("long").alias("illegal_count"), F.col(score).alias("illegal_sum"))

    def one_vehicle(rows: DataFrame) -> DataFrame:
        return rows.withColumn("illegal_vehicle_count", F.col("vehicle_id").isNotNull().cast("long"))

    by_type = _summed(dealt(counted("vehicle_driver_final_score", [*VEHICLE, *TYPE]), *REGION, *VEHICLE), [*REGION, *VEHICLE, *TYPE])
    by_vehicle = _summed(by_type, [*REGION, *VEHICLE])
    of_firms = dealt(counted("enterprise_final_score", [*ENTERPRISE, *TYPE, "vehicle_id"]), *REGION, *ENTERPRISE)
    levels = {
        "type": _with_vehicles(by_type, [*REGION, *TYPE]), "enterprise": _with_vehicles(of_firms, [*REGION, *ENTERPRISE]),
        "enterprise_type": _with_vehicles(of_firms, [*REGION, *ENTERPRISE, *TYPE]), "vehicle": one_vehicle(by_vehicle),
        "vehicle_type": one_vehicle(by_type), "total": _with_vehicles(by_vehicle, REGION),
    }
    columns = [*REGION, *ENTERPRISE, *VEHICLE, *TYPE]
    found = None
    for name, rows in levels.items():
        kept = {*REGION, *RANK_LEVELS[name]}
        part = rows.select(
            F.lit(name).alias("level"),
            *[F.col(c) if c in kept else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in columns],
            "illegal_vehicle_count", "illegal_count", "illegal_sum")
        found = part if found is None else found.unionByName(part)
    return found


def ranked_enterprises(df: DataFrame) -> DataFrame:
    """Enterprises of a department by summed score, highest first, without a score last; scores are summed as decimals,
    so that equal ones tie exactly."""
    exact = df.withColumn("enterprise_final_score", F.col("enterprise_final_score").cast("decimal(18,4)"))
    ranked = with_place(rank_by_enterprise(exact), ["dept_id"], "illegal_sum")
    return ranked.select(
        *REGION, *ENTERPRISE, "illegal_vehicle_count", "illegal_count",
        F.col("illegal_sum").cast("double").alias("illegal_sum"), "place")
