"""The production jobs as compositions of operators, for batch frames and streams alike."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.functions import timefn
from haulwatch.operators import clean, enrich, proximity, tonnage, violations
from haulwatch.sources import frames, messages, schemas
from haulwatch.sources.tables import day_partition, one_partition
from haulwatch.streaming import sinks

BUS_KEY = ["dept_id", "vehicle_id"]


@dataclass(frozen=True)
class Dims:
    service_fee: DataFrame
    driver: DataFrame
    enterprise: DataFrame
    register_card: DataFrame
    transport_card: DataFrame
    area: DataFrame


def enrich_bus(df: DataFrame, dims: Dims) -> DataFrame:
    """Fee, driver, enterprise, permits and region, in this order."""
    df = enrich.paid_service(df, dims.service_fee)
    df = enrich.with_driver(df, dims.driver)
    df = enrich.with_enterprise(df, dims.enterprise)
    df = enrich.with_register_card(df, dims.register_card)
    df = enrich.with_transport_card(df, dims.transport_card)
    return proximity.with_region(df, dims.area)


def _with_seconds(df: DataFrame) -> DataFrame:
    return df.withColumn("t_sec", timefn.epoch_seconds(timefn.parse_time(F.col("time"))))


def frames_to_bus(frames_df: DataFrame, vehicles: DataFrame, dims: Dims, as_of: dt.date) -> DataFrame:
    """Hex frames to the data bus in one hop; undecodable frames are dropped."""
    good, _ = frames.decode_frames(frames_df)
    today = clean.on_day(_with_seconds(good.drop("header", "body")), as_of)
    return enrich_bus(enrich.vehicle_by_terminal(clean.to_bd09(today), vehicles), dims)


def frames_to_positions(frames_df: DataFrame, vehicles: DataFrame, as_of: dt.date) -> DataFrame:
    """First hop of two: strict decoding, plausible positions of the day, vehicle."""
    good, _ = frames.decode_frames(frames_df, mode="FAILFAST")
    kept = clean.plausible(_with_seconds(good.drop("header", "body")), as_of)
    return enrich.vehicle_by_terminal(clean.to_bd09(kept), vehicles)


def plates_to_positions(values: DataFrame, vehicles: DataFrame, as_of: dt.date) -> DataFrame:
    """JSON positions whose device field holds the plate, with their vehicle."""
    rows = _with_seconds(messages.parse_json(values, _struct(schemas.POSITION)))
    today = clean.to_bd09(clean.on_day(rows, as_of)).withColumnRenamed("devid", "plate")
    return enrich.vehicle_by_plate(today, vehicles)


def plates_to_bus(values: DataFrame, vehicles: DataFrame, dims: Dims, as_of: dt.date) -> DataFrame:
    """Plate positions to the data bus in one hop: plausible positions, vehicle, lookups."""
    rows = _with_seconds(messages.parse_json(values, _struct(schemas.POSITION)))
    kept = clean.to_bd09(clean.plausible(rows, as_of)).withColumnRenamed("devid", "plate")
    return enrich_bus(enrich.vehicle_by_plate(kept, vehicles), dims)


def positions_to_bus(values: DataFrame, dims: Dims) -> DataFrame:
    """Second hop of two: JSON positions with vehicle to the data bus."""
    have = {f for d in (dims.driver, dims.enterprise) for f in d.columns}
    have |= {"register_card_state", "coords", "transport_card_state", "service_state", "region_id", "region_name"}
    rows = messages.parse_json(values, _struct(schemas.BUS))
    return enrich_bus(rows.drop(*(have - {"dept_id", "driver_id", "enterprise_id"})), dims)


def bus_messages(df: DataFrame) -> DataFrame:
    return messages.to_json(df, BUS_KEY)


def trip_messages_to_rows(values: DataFrame, schema, processed_at: Column) -> DataFrame:
    """Trip messages to trip table rows; trips without both end points are dropped."""
    return clean.trip_table_row(clean.valid_trips(messages.parse_json(values, schema)), processed_at)


def daily_tonnage(
    trip_table: DataFrame, area_names: DataFrame, amounts: DataFrame, as_of: dt.date,
    statistics_path: str, amount_path: str,
) -> None:
    """Yesterday's trips to the statistics table of yesterday and the running totals of today.

    The statistics are read back from the table just written, so trips are aggregated once and a
    lost executor costs no second pass over them."""
    spark = trip_table.sparkSession
    yesterday = day_partition(as_of, -1)
    daily = tonnage.build_disposal_daily(one_partition(trip_table, as_of))
    sinks.overwrite_static(daily, statistics_path, yesterday)
    folder = "/".join([statistics_path.rstrip("/"), *[f"{k}={v}" for k, v in yesterday.items()]])
    stored = spark.read.schema(daily.schema).parquet(folder)
    total = tonnage.cumulative_amount(stored, area_names, one_partition(amounts, as_of))
    sinks.overwrite_static(total, amount_path, day_partition(as_of))


# table name -> operator over the scoring detail
SCORE_TABLES = {
    "rank_by_type": violations.rank_by_type,
    "rank_by_enterprise": violations.rank_by_enterprise,
    "rank_by_enterprise_type": violations.rank_by_enterprise_type,
    "rank_by_vehicle": violations.rank_by_vehicle,
    "rank_by_vehicle_type": violations.rank_by_vehicle_type,
    "score_by_region_vehicle": violations.score_pivot_region_vehicle,
    "score_by_vehicle": violations.score_pivot_vehicle,
    "score_by_region_enterprise": violations.score_pivot_region_enterprise,
    "score_by_enterprise": violations.score_pivot_enterprise,
    "rank_total": violations.rank_total,
}


def daily_scores(detail: DataFrame, as_of: dt.date, root: str) -> None:
    """The detail table and ten tables made from it, in the partition of the day. The source is
    read once: the ten tables are made from the stored detail."""
    spark = detail.sparkSession
    today = day_partition(as_of)
    scored = violations.scoring_detail(detail)
    sinks.overwrite_static(scored, f"{root}/scoring_detail", today)
    folder = "/".join([f"{root}/scoring_detail", *[f"{k}={v}" for k, v in today.items()]])
    stored = spark.read.schema(scored.schema).parquet(folder)
    for name, operator in SCORE_TABLES.items():
        sinks.overwrite_static(operator(stored), f"{root}/{name}", today)


def _struct(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)
