"""Row-level cleaning of positions and trips. No operator here shuffles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.functions import geo, timefn

# Plausible positions are strictly inside this box (degrees).
LAT_RANGE = (20.0, 40.0)
LNG_RANGE = (100.0, 120.0)
MAX_SPEED = 100.0

# Tonnes per load by vehicle model.
LOAD_BY_MODEL = {"0": 19.32, "16": 19.32, "17": 14.90}

TRIP_POINTS = ["from_site_lng", "from_site_lat", "to_site_lng", "to_site_lat"]

# The columns of the trip table that are always null, in table order.
TRIP_ROW_EMPTY = (
    "device_id", "time", "gps_lng", "gps_lat", "speed", "pos", "gps_flag", "wire_flag", "power_flag", "acc_flag",
    "auxiliary_flag", "temperature", "door", "all_distance", "all_dist_fuel", "gps_distance", "gps_all_distance",
    "report_time", "zxcqi", "alarm_flag", "main_oil_per", "residual_oil", "vice_oil_per", "vice_residual_oil",
    "oil_difference", "sharp_turn", "brake",
)


def admitted(df: DataFrame) -> DataFrame:
    """Vehicles under management that passed the audit; a null state is not admitted."""
    return df.where((F.col("manage_state") == "1") & (F.col("audit_state") == "1"))


def on_date(df: DataFrame, as_of: dt.date, ts: str = "ts") -> DataFrame:
    """Rows of the day ``as_of`` by a stored timestamp: two constants that the scan compares with
    its statistics."""
    start = dt.datetime.combine(as_of, dt.time())
    return df.where((F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (
        F.col(ts) < F.lit(start + dt.timedelta(days=1)).cast("timestamp_ntz")))


def on_day(df: DataFrame, as_of: dt.date, sec: str = "t_sec") -> DataFrame:
    """Rows whose event day is ``as_of`` by their seconds, for decoded messages."""
    start = (as_of - dt.date(1970, 1, 1)).days * 86400
    return df.where((F.col(sec) >= start) & (F.col(sec) < start + 86400))


def plausible(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Positions inside the service box at a possible speed, optionally of one day only."""
    lat, lng, speed = F.col("lat"), F.col("lng"), F.col("speed")
    kept = df.where(
        (lat > LAT_RANGE[0]) & (lat < LAT_RANGE[1])
        & (lng > LNG_RANGE[0]) & (lng < LNG_RANGE[1])
        & (speed >= 0) & (speed < MAX_SPEED)
    )
    return kept if as_of is None else on_day(kept, as_of)


def to_bd09(df: DataFrame) -> DataFrame:
    """WGS-84 lat/lng replaced by BD-09. Apply after :func:`plausible`, which expects WGS."""
    gcj_lng, gcj_lat = geo.wgs_to_gcj(F.col("lng"), F.col("lat"))
    mid = df.withColumns({"_lng": gcj_lng, "_lat": gcj_lat})
    lng, lat = geo.gcj_to_bd(F.col("_lng"), F.col("_lat"))
    return mid.withColumns({"lng": lng, "lat": lat}).drop("_lng", "_lat")


def bd09_to_gcj02(df: DataFrame) -> DataFrame:
    lng, lat = geo.bd_to_gcj(F.col("lng"), F.col("lat"))
    return df.withColumns({"_lng": lng, "_lat": lat}).drop("lng", "lat").withColumnsRenamed(
        {"_lng": "lng", "_lat": "lat"}
    )


def load_by_model(model: Column) -> Column:
    """Tonnes of a trip; 0 for other and unknown models."""
    out = None
    for code, tonnes in LOAD_BY_MODEL.items():
        out = (F if out is None else out).when(model == code, tonnes)
    return out.otherwise(0.0)


def empty_flag(from_site_flag: Column) -> Column:
    """0 = loaded (the trip left a building site), 1 = empty."""
    return F.when(from_site_flag == 1, 0).otherwise(1)


def valid_trips(df: DataFrame) -> DataFrame:
    """Trips with both end points known."""
    return df.dropna(subset=TRIP_POINTS)


def trip_table_row(df: DataFrame, processed_at: Column) -> DataFrame:
    """A trip as a row of the trip table: 64 columns, the last three its partition."""
    def end(prefix: str, letter: str) -> dict[str, Column]:
        return {
            f"{letter}_site_time": F.col(f"{prefix}_site_inter_time"),
            **{
                f"{letter}_site_{part}": F.col(f"{prefix}_site_{part}").cast("string")
                for part in ("id", "name", "province_id", "city_id", "area_id")
            },
            # found by reverse geocoding, an outside service
            f"{letter}_site_address": F.lit(None).cast("string"),
            f"{letter}_site_lat": F.col(f"{prefix}_site_lat").cast("double"),
            f"{letter}_site_lng": F.col(f"{prefix}_site_lng").cast("double"),
            f"{letter}_site_flag": F.coalesce(F.col(f"{prefix}_site_flag").cast("int"), F.lit(-1)),
        }

    start = end("from", "s")
    start["s_site_time"] = F.coalesce(start["s_site_time"], F.lit(""))
    start_order = ("id", "name", "flag", "lng", "lat", "area_id", "province_id", "city_id", "address", "time")
    columns = {name: F.lit(None).cast("string") for name in TRIP_ROW_EMPTY}
    columns |= end("to", "e")
    columns |= {"status": F.lit(0), "dev_id": F.lit(None).cast("string"), "dev_status": F.lit(0)}
    columns |= {f"s_site_{part}": start[f"s_site_{part}"] for part in start_order}
    columns |= {
        "updatetime": F.date_format(processed_at, timefn.TIME_FORMAT),
        "dept_id": F.col("dept_id").cast("int"),
        "vehicle_id": F.col("vehicle_id").cast("long"),
        "transport_enterprise_id": F.col("enterprise_id").cast("string"),
        "car_card_number": F.col("car_card_number"),
        "load": F.col("load").cast("double"),
        "enterprise_name": F.col("enterprise_name"),
        "province_id": F.col("province_id").cast("string"),
        "city_id": F.col("city_id").cast("string"),
        "area_id": F.col("area_id").cast("string"),
        "vehicle_empty": F.col("vehicle_empty").cast("int"),
    }
    columns |= timefn.partition_columns(processed_at)
    return df.select(*[column.alias(name) for name, column in columns.items()])


def with_partition(df: DataFrame, ts: Column) -> DataFrame:
    return df.withColumns(timefn.partition_columns(ts))
