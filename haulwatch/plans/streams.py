"""The streaming jobs: a stream of bus positions in, a stream of results out.

Each function returns a streaming DataFrame. Start it with a sink of
:mod:`haulwatch.streaming.sinks`, a checkpoint folder and a trigger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.operators import alarms, clean, movement, proximity
from haulwatch.streaming import machines
from haulwatch.streaming.stateful import run_machine

KEY = ["dept_id", "vehicle_id"]


# ``timing`` of the jobs: allowance and report_late of :func:`run_machine`.


def trips(bus: DataFrame, sites: DataFrame, strict: bool = False, **timing) -> DataFrame:
    sited = proximity.with_site(clean.admitted(bus), sites)
    out = run_machine(sited, machines.TripMachine(strict=strict), KEY, **timing)
    return out.withColumn("vehicle_empty", clean.empty_flag(F.col("from_site_flag")))


def trip_records(
    bus: DataFrame, sites: DataFrame, vehicles: DataFrame, enterprises: DataFrame, strict: bool = False, **timing
) -> DataFrame:
    """Trips with all columns of the batch operator: places, names, vehicle, enterprise, load."""
    return movement.with_trip_dims(trips(bus, sites, strict, **timing), sites, vehicles, enterprises)


def trip_table(
    bus: DataFrame, sites: DataFrame, vehicles: DataFrame, enterprises: DataFrame, processed_at: Column, **timing
) -> DataFrame:
    """Rows of the trip table: trips with both end points known."""
    records = trip_records(bus, sites, vehicles, enterprises, strict=True, **timing)
    return clean.trip_table_row(clean.valid_trips(records), processed_at)


def fence_alarms(bus: DataFrame, rules: DataFrame, **timing) -> DataFrame:
    marked = proximity.with_violations(clean.admitted(bus), rules)
    # violations are in match order: of each code the first
    codes = F.transform("violations", lambda v: F.to_json(F.struct(*[v[c].alias(c) for c in ["illegal_type_code", *alarms.FENCE]])))
    machine = machines.EpisodeMachine(codes="codes", details=tuple(alarms.FENCE), output=machines.FENCE_OUTPUT)
    return run_machine(marked.withColumn("codes", codes), machine, KEY, **timing)


def gps_incomplete_alarms(bus: DataFrame, **timing) -> DataFrame:
    standing = F.when(F.col("speed") == 0, True).when(F.col("speed") > 0, False)
    machine = machines.EpisodeMachine(code=alarms.GPS_INCOMPLETE, offends="standing", jump_m=alarms.GPS_JUMP_M)
    return run_machine(clean.admitted(bus).withColumn("standing", standing), machine, KEY, **timing)


def off_route_alarms(bus: DataFrame, cards: DataFrame | None = None, **timing) -> DataFrame:
    points = alarms.off_route_points(clean.admitted(bus), cards)
    return run_machine(points, machines.EpisodeMachine(code=alarms.OFF_ROUTE, offends="off_route"), KEY, **timing)


def no_register_alarms(bus: DataFrame, **timing) -> DataFrame:
    missing = clean.admitted(bus).withColumn("offends", F.col("register_card_state") == 0)
    return run_machine(missing, machines.DailyAlarmMachine(), KEY, **timing)


def online_time(bus: DataFrame, **timing) -> DataFrame:
    return run_machine(clean.admitted(bus), machines.OnlineMachine(), KEY, **timing)


def stops(bus: DataFrame, gap: int = 180, **timing) -> DataFrame:
    return run_machine(clean.admitted(bus), machines.StopMachine(gap=gap), KEY, **timing)


def dwell(bus: DataFrame, sites: DataFrame, **timing) -> DataFrame:
    """Visits of disposal sites. Sites at the same places share one visit until it is over."""
    places, members = proximity.together(proximity.audited_disposal(sites))
    marked = proximity.with_near_ids(clean.admitted(bus), places)
    visits = run_machine(marked, machines.DwellMachine(), KEY, **timing)
    listed = members.groupBy("dept_id", "group_id").agg(F.collect_list("site_id").alias("_members"))
    # Under its new name the column makes Spark turn the function's rows into its own, as a shuffle wants them. A late
    # position is of no site.
    found = visits.withColumnRenamed("site_id", "group_id").join(listed, ["dept_id", "group_id"], "left")
    each = found.withColumn("site_id", F.explode_outer("_members"))
    return each.select(*visits.columns)


def illegal_disposal(bus: DataFrame, sites: DataFrame, cards: DataFrame, **timing) -> DataFrame:
    """Thinned alarms of positions near a site that the vehicle has no permit for, with the first such site."""
    points = alarms.illegal_disposal_points(clean.admitted(bus), sites, cards)
    places = {"start_sec": "t_sec", "start_event_id": "event_id", "alarm_start_lng": "lng", "alarm_start_lat": "lat"}
    machine = machines.PointAlarmMachine(alarms.ILLEGAL_DISPOSAL)
    return run_machine(points.withColumnsRenamed(places), machine, KEY, **timing)


def enriched_alarms(found: DataFrame, scores: DataFrame, processed_at: Column) -> DataFrame:
    return alarms.enrich_alarms(found, scores, processed_at)

