"""Lookup joins of positions with dimension tables.

No join carries a broadcast hint: Spark broadcasts a dimension whose size is below its limit
and shuffles a larger one, where the adaptive skew join splits hot vehicles. Dimensions are
reduced to one row per key first, so a lookup never multiplies positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwatch.functions import geo
from haulwatch.sources.tables import latest_per_key

VEHICLE_KEY = ["dept_id", "vehicle_id"]


def _unique(dim: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    """One row per key: the last in ``order``, by default in the order of all columns."""
    return latest_per_key(dim, keys, order or [c for c in dim.columns if c not in keys] or keys)


def vehicle_by_terminal(df: DataFrame, vehicles: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Positions of known devices, with the vehicle's columns."""
    dim = _unique(vehicles.where(F.col("terminal_id").isNotNull()), ["terminal_id"], order)
    return df.join(dim, F.trim(df["devid"]) == dim["terminal_id"], "inner").drop("terminal_id")


def vehicle_by_plate(df: DataFrame, vehicles: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Positions that carry a plate instead of a device; the device comes from the vehicle."""
    dim = _unique(vehicles.where(F.col("car_card_number").isNotNull()), ["car_card_number"], order)
    base = df.drop("devid")
    return base.join(dim, base["plate"] == dim["car_card_number"], "inner").drop("plate").withColumnRenamed(
        "terminal_id", "devid"
    )


def paid_service(df: DataFrame, fees: DataFrame) -> DataFrame:
    """Only vehicles with a valid service fee; they get service_state 1."""
    paid = fees.where(F.col("state") == 0).select(*VEHICLE_KEY)
    return df.join(paid, VEHICLE_KEY, "left_semi").withColumn("service_state", F.lit(1))


def with_driver(df: DataFrame, drivers: DataFrame, order: list[str] | None = None) -> DataFrame:
    dim = _unique(drivers, ["dept_id", "driver_id"], order)
    return df.join(dim, ["dept_id", "driver_id"], "left")


def with_enterprise(df: DataFrame, enterprises: DataFrame, order: list[str] | None = None) -> DataFrame:
    dim = _unique(enterprises, ["dept_id", "enterprise_id"], order)
    return df.join(dim, ["dept_id", "enterprise_id"], "inner")


def card_routes(cards: DataFrame) -> DataFrame:
    """Valid permits per vehicle: flag 1 and the routes of all permits, '|' between them.
    Equal routes of one vehicle are kept once, which changes no distance to a route."""
    valid = cards.where(F.col("state") == 0)
    per_route = valid.groupBy(*VEHICLE_KEY, "coords").agg(F.min("card_id").alias("card_id"))
    listed = F.array_sort(F.collect_list(F.struct("card_id", "coords")))
    return per_route.groupBy(*VEHICLE_KEY).agg(
        F.lit(1).alias("register_card_state"),
        F.array_join(F.transform(listed, lambda c: c["coords"]), "|").alias("coords"),
    )


def with_register_card(df: DataFrame, cards: DataFrame) -> DataFrame:
    """Adds the permit flag and the routes as text."""
    base = df.drop("register_card_state", "coords")
    return base.join(card_routes(cards), VEHICLE_KEY, "left").withColumn(
        "register_card_state", F.coalesce("register_card_state", F.lit(0))
    )


def with_transport_card(df: DataFrame, cards: DataFrame) -> DataFrame:
    valid = cards.where(F.col("state") == 1).select(*VEHICLE_KEY).distinct()
    flagged = valid.withColumn("transport_card_state", F.lit(1))
    return df.join(flagged, VEHICLE_KEY, "left").withColumn(
        "transport_card_state", F.coalesce("transport_card_state", F.lit(0))
    )


def allowed_disposal_sites(cards: DataFrame, sites: DataFrame) -> DataFrame:
    """Which disposal sites a vehicle may use: valid permit and a live site that passed the audit."""
    live = sites.where((F.col("site_flag") == 2) & (F.col("is_delete") == 0) & (F.col("audit_state") == "1"))
    permits = cards.where(F.col("state") == 0).select("vehicle_id", "disposal_site_id").distinct()
    dim = live.select(
        F.col("site_id").alias("disposal_site_id"), F.col("site_name").alias("disposal_site_name"),
        "lng", "lat",
    )
    return permits.join(dim, "disposal_site_id", "inner")


def track_allowed_sites(df: DataFrame, allowed: DataFrame) -> DataFrame:
    """Positions with the list of sites their vehicle may use. A vehicle has at most as many
    entries as there are sites, because permits were made distinct."""
    located = allowed.where(F.col("lng").isNotNull() & F.col("lat").isNotNull())
    entry = F.struct("disposal_site_id", "disposal_site_name", "lng", "lat")
    lists = located.groupBy("vehicle_id").agg(F.array_sort(F.collect_list(entry)).alias("allowed_sites"))
    return df.join(lists, "vehicle_id", "left")


def alarm_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Score columns of the alarm's type in its department."""
    dim = _unique(scores, ["dept_id", "illegal_type_code"], None)
    return df.join(dim, ["dept_id", "illegal_type_code"], "left")


