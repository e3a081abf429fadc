"""Queries by name: each takes (spark, folder) and runs one operator over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.functions import geo, timefn
from haulwatch.operators import alarms, clean, enrich, movement, proximity, tonnage, violations
from haulwatch.session import new_shared_path, stored
from haulwatch.sources import frames, messages, schemas, tables
from haulwatch.sources.derived import view
from haulwatch.streaming import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.date(2024, 1, 15)
PROCESSED_AT = "TIMESTAMP_NTZ'2024-01-31 07:05:09'"


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(name: str, digits: int = 6):
    return F.round(F.col(name), digits).alias(name)


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    return df.select(
        *[
            r6(f.name, special.get(f.name, digits)) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def admitted(spark: SparkSession, folder: str) -> DataFrame:
    return clean.admitted(view(spark, folder, "v_track"))


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Positions as the data bus carries them."""
    return clean.plausible(admitted(spark, folder))


def sited(spark: SparkSession, folder: str) -> DataFrame:
    vehicles = view(spark, folder, "v_vehicle").select(
        "dept_id", "vehicle_id", "vehicle_model_id", "car_card_number", "enterprise_id"
    )
    tracks = proximity.with_site(cleaned(spark, folder), view(spark, folder, "v_site"))
    known = tracks.join(vehicles, ["dept_id", "vehicle_id"], "left")
    return known.join(view(spark, folder, "v_enterprise"), ["dept_id", "enterprise_id"], "left")


# ---- sources and sinks ------------------------------------------------------------------


@register
def src_bus_json(spark, folder):
    """Positions written as JSON messages and parsed back."""
    tracks = view(spark, folder, "v_track").drop("ts")
    parsed = messages.parse_json(messages.to_json(tracks), tracks.schema)
    return parsed.select("event_id", "vehicle_id", "dept_id", "t_sec", "speed", r6("lat"), r6("lng"), "audit_state")


@register
def bus_to_json(spark, folder):
    tracks = view(spark, folder, "v_track").select(
        "event_id", "vehicle_id", "dept_id", "t_sec", "manage_state", "audit_state"
    )
    return messages.to_json(tracks, ["dept_id", "vehicle_id"])


@register
def dim_scan(spark, folder):
    return view(spark, folder, "v_vehicle").select("vehicle_id", "terminal_id", "car_card_number", "dept_id")


@register
def partition_scan(spark, folder):
    """One day of a partitioned table, found by partition pruning."""
    tracks = clean.with_partition(view(spark, folder, "v_track"), F.col("ts"))
    path = new_shared_path(spark, "tracks")
    sinks.append_partitioned(tracks.drop("ts"), path, ["month_id", "day_id"])
    stored = spark.read.schema(tracks.drop("ts").schema).parquet(path)
    return rounded(tables.one_partition(stored, AS_OF).select("event_id", "vehicle_id", "speed", "month_id", "day_id"))


@register
def trips_partitioned(spark, folder):
    """Trips appended to the partitioned trip table, counted per partition."""
    rows = clean.trip_table_row(_trips(spark, folder), F.expr(PROCESSED_AT))
    path = new_shared_path(spark, "trips")
    sinks.append_partitioned(rows, path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("month_id", "day_id", "hour_id").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("load"), 4).alias("tonnes")
    )


@register
def overwrite_partition(spark, folder):
    """A day partition written twice holds the second version only; other days stay."""
    daily = stored(tonnage.build_disposal_daily(view(spark, folder, "v_trip")), "tonnage")  # written three times
    path = new_shared_path(spark, "daily")
    today, before = tables.day_partition(AS_OF), tables.day_partition(AS_OF, -1)
    for values, part in ((before, daily), (today, daily), (today, daily.where(F.col("build_count") > 0))):
        sinks.overwrite_static(part, path, values)
    schema = daily.schema.simpleString()[7:-1] + ",month_id:string,day_id:string"
    written = spark.read.schema(schema.replace(":", " ")).parquet(path)
    return written.groupBy("month_id", "day_id").agg(
        F.count(F.lit(1)).alias("site_rows"), F.round(F.sum("build_sum"), 4).alias("build_sum"),
        F.round(F.sum("disposal_sum"), 4).alias("disposal_sum"),
    )


@register
def bus_docs(spark, folder):
    """Positions written as JSON documents, once per event, and read back."""
    tracks = view(spark, folder, "v_track").drop("ts")
    path = new_shared_path(spark, "docs")
    for _ in range(2):  # a replay of the batch replaces its documents
        sinks.write_documents(tracks.unionByName(tracks), path, "event_id", batch_id=0)
    back = spark.read.schema(tracks.schema).json(path)
    return back.select("event_id", "vehicle_id", "t_sec", "speed", "audit_state")


@register
def bus_partitioned(spark, folder):
    """Positions stored by day, counted per stored partition and hour."""
    tracks = clean.with_partition(view(spark, folder, "v_track"), F.col("ts")).drop("ts")
    path = new_shared_path(spark, "bus")
    sinks.append_partitioned(tracks, path, ["month_id", "day_id"])
    stored = spark.read.schema(tracks.schema).parquet(path)
    return stored.groupBy("month_id", "day_id", "hour_id").agg(F.count(F.lit(1)).alias("positions"))


@register
def vehicle_current_state(spark, folder):
    known = view(spark, folder, "v_vehicle").select("dept_id", "vehicle_id", "car_card_number")
    return rounded(movement.vehicle_current_state(admitted(spark, folder), known))


# ---- frames -----------------------------------------------------------------------------


def _good(spark, folder):
    return frames.decode_frames(view(spark, folder, "v_frame"))[0]


@register
def decode_frames(spark, folder):
    return _good(spark, folder).select(
        "event_id", "devid", "time", r6("lat"), r6("lng"), "point", "speed", "pos", "gpsflag",
        "accflag", "auxiliaryflag", "altitude", "gpsdistance", "mainoilper", "sharpturn", "brake",
    )


@register
def frame_header(spark, folder):
    parsed = frames.parse_frames(view(spark, folder, "v_frame")).where(F.col("header").isNotNull())
    return parsed.select("event_id", "header.*")


@register
def frame_checksum(spark, folder):
    parsed = frames.parse_frames(view(spark, folder, "v_frame")).where(F.col("reject_reason").isNull())
    return parsed.select("event_id", "checksum", "checksum_ok")


@register
def frame_state_bits(spark, folder):
    bits = frames.state_bits(F.col("state_word"))
    return _good(spark, folder).select("event_id", *[c.alias(n) for n, c in bits.items()])


@register
def frame_alarm_bits(spark, folder):
    bits = frames.alarm_bits(F.col("alarm_word"))
    return _good(spark, folder).select("event_id", *[c.alias(n) for n, c in bits.items()])


@register
def frame_tlv(spark, folder):
    good = _good(spark, folder)
    return good.select("event_id", F.explode("tlv").alias("item_id", "payload"))


@register
def decode_rejects(spark, folder):
    return frames.decode_frames(view(spark, folder, "v_frame"))[1].select("event_id", "reject_reason")


# ---- cleaning ---------------------------------------------------------------------------


@register
def admitted_tracks(spark, folder):
    return admitted(spark, folder).select("event_id", "vehicle_id", "dept_id", "t_sec", "speed")


@register
def plausible_tracks(spark, folder):
    return rounded(clean.plausible(view(spark, folder, "v_track")).select("event_id", "lat", "lng", "speed"))


@register
def today_tracks(spark, folder):
    return clean.on_date(view(spark, folder, "v_track"), AS_OF).select("event_id", "vehicle_id", "t_sec")


@register
def tracks_bd09(spark, folder):
    tracks = clean.to_bd09(clean.plausible(view(spark, folder, "v_track")))
    return rounded(tracks.select("event_id", "lat", "lng"))


@register
def tracks_bd2gcj(spark, folder):
    return rounded(clean.bd09_to_gcj02(view(spark, folder, "v_track")).select("event_id", "lat", "lng"))


@register
def partition_cols(spark, folder):
    return clean.with_partition(view(spark, folder, "v_track"), F.col("ts")).select(
        "event_id", "month_id", "day_id", "hour_id"
    )


@register
def trip_load(spark, folder):
    vehicles = view(spark, folder, "v_vehicle")
    return vehicles.select("vehicle_id", clean.load_by_model(F.col("vehicle_model_id")).alias("load"))


# ---- lookups ----------------------------------------------------------------------------


@register
def dim_dedup(spark, folder):
    return tables.latest_per_key(view(spark, folder, "v_vehicle_history"), ["vehicle_id"], ["version"])


@register
def join_vehicle_by_terminal(spark, folder):
    raw = view(spark, folder, "v_raw_track").drop("plate")
    out = enrich.vehicle_by_terminal(raw, view(spark, folder, "v_vehicle"))
    return rounded(out.select(
        "event_id", "devid", "vehicle_id", "car_card_number", "vehicle_model_id", "driver_id", "enterprise_id",
        "dept_id", "speed",
    ))


@register
def join_vehicle_by_plate(spark, folder):
    out = enrich.vehicle_by_plate(view(spark, folder, "v_raw_track"), view(spark, folder, "v_vehicle"))
    return rounded(out.select("event_id", "devid", "vehicle_id", "car_card_number", "enterprise_id", "dept_id", "speed"))


def _vehicled(spark, folder):
    raw = clean.plausible(view(spark, folder, "v_raw_track")).drop("plate")
    return enrich.vehicle_by_terminal(raw, view(spark, folder, "v_vehicle"))


@register
def semi_service_fee(spark, folder):
    out = enrich.paid_service(view(spark, folder, "v_track"), view(spark, folder, "v_service_fee"))
    return out.select("event_id", "dept_id", "vehicle_id", "service_state")


@register
def join_driver(spark, folder):
    out = enrich.with_driver(_vehicled(spark, folder), view(spark, folder, "v_driver"))
    return out.select("event_id", "dept_id", "vehicle_id", "driver_id", "driver_card_number", "driver_name")


@register
def join_enterprise(spark, folder):
    out = enrich.with_enterprise(_vehicled(spark, folder), view(spark, folder, "v_enterprise"))
    return out.select("event_id", "dept_id", "vehicle_id", "enterprise_id", "enterprise_name", "province_id")


@register
def join_register_card(spark, folder):
    out = enrich.with_register_card(view(spark, folder, "v_track"), view(spark, folder, "v_register_card"))
    return out.select("event_id", "dept_id", "vehicle_id", "register_card_state", "coords")


@register
def join_transport_card(spark, folder):
    out = enrich.with_transport_card(view(spark, folder, "v_track"), view(spark, folder, "v_transport_card"))
    return out.select("event_id", "dept_id", "vehicle_id", "transport_card_state")


@register
def data_bus(spark, folder):
    """All lookups in the order of the enrichment job."""
    from haulwatch.plans.jobs import Dims, enrich_bus

    dims = Dims(**{name: view(spark, folder, f"v_{name}") for name in Dims.__dataclass_fields__})
    bus = enrich_bus(_vehicled(spark, folder), dims)
    return rounded(bus.select(
        "event_id", "vehicle_id", "dept_id", "driver_name", "enterprise_name", "register_card_state",
        "transport_card_state", "service_state", "region_id", "region_name", "speed",
    ))


@register
def join_region(spark, folder):
    out = proximity.with_region(admitted(spark, folder), view(spark, folder, "v_area"))
    return out.select("event_id", "region_id", "region_name")


@register
def all_sites(spark, folder):
    sites = view(spark, folder, "v_site")
    build, disposal = (sites.where(F.col("site_flag") == f).drop("site_flag") for f in (1, 2))
    return rounded(proximity.all_sites(build, disposal).drop("is_delete"))


@register
def join_site_500m(spark, folder):
    out = proximity.with_site(admitted(spark, folder), view(spark, folder, "v_site"))
    return rounded(out.select("event_id", "site_id", "site_name", "site_flag", "site_lng", "site_lat"))


def _rules(spark, folder):
    names = {1: "v_rule_speed", 2: "v_rule_penalty", 3: "v_rule_work_time", 4: "v_rule_out", 5: "v_rule_document"}
    return proximity.fence_rules(
        {flag: view(spark, folder, name) for flag, name in names.items()}, view(spark, folder, "v_boundary")
    )


@register
def fence_rules(spark, folder):
    return _rules(spark, folder).select(
        "condition_id", "dept_id", "fence_flag", "speed", "start_date", "end_date", "name", "coords", "area_id"
    )


@register
def fence_violations(spark, folder):
    out = proximity.fence_violations(admitted(spark, folder), view(spark, folder, "v_fence_rule"))
    return out.select("event_id", *alarms.FENCE, "illegal_type_code")


@register
def allowed_disposal_sites(spark, folder):
    out = enrich.allowed_disposal_sites(view(spark, folder, "v_register_card"), view(spark, folder, "v_site"))
    return rounded(out.select("vehicle_id", "disposal_site_id", "disposal_site_name", "lng", "lat"))


@register
def track_allowed_sites(spark, folder):
    allowed = enrich.allowed_disposal_sites(view(spark, folder, "v_register_card"), view(spark, folder, "v_site"))
    out = enrich.track_allowed_sites(admitted(spark, folder), allowed)
    ids = F.transform("allowed_sites", lambda s: s["disposal_site_id"].cast("string"))
    return out.select("event_id", "vehicle_id", F.array_join(ids, ",").alias("sites"))


@register
def inout_pairs(spark, folder):
    disposal = proximity.audited_disposal(view(spark, folder, "v_site"))
    return proximity.near_sites(admitted(spark, folder), disposal).select("event_id", "vehicle_id", "site_id")


# ---- tonnage ----------------------------------------------------------------------------


@register
def build_stats(spark, folder):
    return rounded(tonnage.build_stats(view(spark, folder, "v_trip")), 4)


@register
def disposal_stats(spark, folder):
    return rounded(tonnage.disposal_stats(view(spark, folder, "v_trip")), 4)


@register
def build_disposal_daily(spark, folder):
    return rounded(tonnage.build_disposal_daily(view(spark, folder, "v_trip")), 4)


@register
def area_rollup(spark, folder):
    daily = tonnage.build_disposal_daily(view(spark, folder, "v_trip"))
    return rounded(tonnage.area_rollup(daily, view(spark, folder, "v_area_name")), 4)


@register
def site_totals(spark, folder):
    return rounded(tonnage.site_totals(tonnage.build_disposal_daily(view(spark, folder, "v_trip"))), 4)


@register
def cumulative_amount(spark, folder):
    daily = tonnage.build_disposal_daily(view(spark, folder, "v_trip"))
    before = view(spark, folder, "v_amount")
    return rounded(tonnage.cumulative_amount(daily, view(spark, folder, "v_area_name"), before), 4)


# ---- violations -------------------------------------------------------------------------


def _detail(spark, folder):
    return violations.scoring_detail(view(spark, folder, "v_illegal"))


@register
def scoring_detail(spark, folder):
    detail = _detail(spark, folder)
    return rounded(detail.select(
        "vehicle_id", "car_card_number", "enterprise_name", "illegal_id", "illegal_name", "enterprise_final_score",
        "vehicle_driver_final_score", "transport_enterprise_id", "province_id", "city_id", "area_id", "dept_id",
        F.date_format("illegal_date", timefn.TIME_FORMAT).alias("illegal_date"),
    ), 4)


def _violation_query(name: str) -> None:
    operator = getattr(violations, name)

    def query(spark, folder):
        return rounded(operator(_detail(spark, folder)), 4)

    query.__name__ = name
    register(query)


for _name in (
    "rank_by_type", "rank_by_enterprise", "rank_by_enterprise_type", "rank_by_vehicle", "rank_by_vehicle_type",
    "rank_total", "score_pivot_region_vehicle", "score_pivot_vehicle", "score_pivot_region_enterprise",
    "score_pivot_enterprise", "rank_grouping_sets", "ranked_enterprises",
):
    _violation_query(_name)


# ---- functions --------------------------------------------------------------------------


@register
def geo_distance(spark, folder):
    """Distance of every position from the reference corner of the grid."""
    d = geo.distance_m(F.col("lng"), F.col("lat"), F.lit(113.6), F.lit(34.7))
    return view(spark, folder, "v_track").select("event_id", F.round(d, 4).alias("metres"))


@register
def off_route_points(spark, folder):
    out = alarms.off_route_points(admitted(spark, folder), view(spark, folder, "v_register_card"))
    return out.select("event_id", "vehicle_id", "off_route")


@register
def in_time_range(spark, folder):
    t = F.col("t_sec")
    return view(spark, folder, "v_track").select(
        "event_id", timefn.in_time_range(t, F.lit("06:00"), F.lit("22:30:00")).alias("by_day"),
        timefn.in_time_range(t, F.lit("22:00"), F.lit("06:00")).alias("by_night"),
    )


@register
def in_effective_date(spark, folder):
    inside = timefn.in_effective_date(F.col("t_sec"), F.lit("2024-01-10 00:00"), F.lit("2024-01-20 12:00"))
    return view(spark, folder, "v_track").select("event_id", inside.alias("effective"))


@register
def elapsed(spark, folder):
    spent = F.col("t_sec") - timefn.epoch_seconds(F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return view(spark, folder, "v_track").select(
        "event_id", timefn.whole_units(spent, 60).alias("minutes"), timefn.whole_units(spent, 3600).alias("hours")
    )


@register
def alarm_interval(spark, folder):
    spent = F.col("t_sec") % 20000
    return view(spark, folder, "v_track").select(
        "event_id", timefn.duration_text(spent).alias("interval_time"),
        timefn.duration_text(spent, strict=True).alias("interval_strict"),
    )


# ---- alarms and movement ----------------------------------------------------------------


@register
def gps_incomplete_alarms(spark, folder):
    return rounded(alarms.gps_incomplete_alarms(cleaned(spark, folder)))


@register
def fence_alarms(spark, folder):
    return rounded(alarms.fence_alarms(cleaned(spark, folder), view(spark, folder, "v_fence_rule")))


@register
def off_route_alarms(spark, folder):
    return rounded(alarms.off_route_alarms(cleaned(spark, folder), view(spark, folder, "v_register_card")))


@register
def no_register_alarms(spark, folder):
    return rounded(alarms.no_register_alarms(admitted(spark, folder)))


@register
def alarm_thinning(spark, folder):
    """Thinning alone: every position counts as an alarm that starts there."""
    tracks = admitted(spark, folder)
    code = F.when(F.col("event_id") % 3 == 0, alarms.DOCUMENT_CONTROL).otherwise("0110")
    raw = tracks.select(
        "dept_id", "vehicle_id", code.alias("illegal_type_code"), F.col("t_sec").alias("start_sec"),
        F.col("event_id").alias("start_event_id"),
    )
    return alarms.thin_alarms(raw)


@register
def alarm_scores(spark, folder):
    tracks = view(spark, folder, "v_track").select(
        "event_id", "dept_id", F.when(F.col("event_id") % 2 == 0, "0118").otherwise("0115").alias("illegal_type_code")
    )
    return enrich.alarm_scores(tracks, view(spark, folder, "v_score"))


@register
def alarm_enriched(spark, folder):
    found = alarms.gps_incomplete_alarms(cleaned(spark, folder))
    out = alarms.enrich_alarms(found, view(spark, folder, "v_score"), F.expr(PROCESSED_AT))
    return rounded(out.select(
        "dept_id", "vehicle_id", "illegal_type_code", "start_sec", "end_sec", "interval_time", "interval_distance",
        "illegal_type_short_desc", "enterprise_score", "vehicle_score", "driver_score", "scoring_year", "uuid",
        "month_id", "day_id", "hour_id",
    ), 4)


@register
def illegal_disposal(spark, folder):
    out = alarms.illegal_disposal(
        cleaned(spark, folder), view(spark, folder, "v_site"), view(spark, folder, "v_register_card")
    )
    return rounded(out.select(
        "dept_id", "vehicle_id", "illegal_type_code", "site_id", "start_sec", "start_event_id", "alarm_start_lng",
        "alarm_start_lat",
    ))


def _trips(spark, folder, strict=False):
    return movement.trips(sited(spark, folder), strict)


TRIP_COLUMNS = [
    "dept_id", "vehicle_id", "from_site_id", "from_site_name", "from_site_flag", "from_site_inter_sec",
    "from_site_work_sec", "from_site_leave_sec", "to_site_id", "to_site_name", "to_site_flag", "to_site_inter_sec",
    "load", "vehicle_empty",
]


@register
def trips(spark, folder):
    return _trips(spark, folder).select(*TRIP_COLUMNS)


@register
def trips_strict(spark, folder):
    return _trips(spark, folder, strict=True).select(*TRIP_COLUMNS)


@register
def valid_trips(spark, folder):
    return clean.valid_trips(_trips(spark, folder, strict=True)).select(*TRIP_COLUMNS)


@register
def trips_table_row(spark, folder):
    return rounded(clean.trip_table_row(_trips(spark, folder), F.expr(PROCESSED_AT)))


@register
def vehicle_online_time(spark, folder):
    return movement.vehicle_online_time(admitted(spark, folder)).select(
        "event_id", "vehicle_id", "t_sec", "online_time", "vehicle_status", "online_status"
    )


@register
def stop_episodes(spark, folder):
    return rounded(movement.stop_episodes(cleaned(spark, folder), gap=3600))


@register
def stop_episodes_three_minutes(spark, folder):
    return rounded(movement.stop_episodes(cleaned(spark, folder)))


@register
def inout_dwell(spark, folder):
    return movement.inout_dwell(cleaned(spark, folder), view(spark, folder, "v_site"))


@register
def hourly_track_counts(spark, folder):
    return rounded(movement.hourly_track_counts(view(spark, folder, "v_track")), 4)
