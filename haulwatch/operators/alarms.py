"""Alarms: fence, GPS gap, missing permit, off route, illegal disposal; thinning; enrichment.

An alarm of the first, second and fourth kind is an episode: it opens at the first offending
position and closes at the next position that does not offend. Short episodes are dropped and
what is left is thinned per vehicle and code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwatch.functions import geo, timefn
from haulwatch.operators import enrich
from haulwatch.operators.chains import ChainRule, greedy_chain
from haulwatch.operators.enrich import card_routes
from haulwatch.operators.ordered import DAY, episodes, timed
from haulwatch.operators.proximity import audited_disposal, off_route, together, with_near_ids, with_violations

KEY = ["dept_id", "vehicle_id"]

# Alarm codes.
GPS_INCOMPLETE = "0118"
NO_REGISTER_CARD = "0111"
OFF_ROUTE = "0112"
DOCUMENT_CONTROL = "0119"
ILLEGAL_DISPOSAL = "0123"

MIN_EPISODE_SECONDS = 240  # more than three whole minutes
THINNING_SECONDS = 7200
GPS_JUMP_M = 2000.0
FENCE = ["fence_flag", "fence_id", "fence_name", "fence_area_id"]


def _candidates(paired: DataFrame, code: Column | None = None, extra: list[str] | None = None) -> DataFrame:
    """Episodes that lasted long enough, as alarm rows."""
    out = paired.where(F.col("closed.t_sec") - F.col("opened.t_sec") >= MIN_EPISODE_SECONDS)
    columns = [*KEY, (F.col("illegal_type_code") if code is None else code).alias("illegal_type_code")]
    columns += [F.col(f"opened.{c}").alias(c) for c in extra or []]
    columns += [
        F.col("opened.t_sec").alias("start_sec"), F.col("opened.event_id").alias("start_event_id"),
        F.col("opened.lng").alias("alarm_start_lng"), F.col("opened.lat").alias("alarm_start_lat"),
        F.col("closed.t_sec").alias("end_sec"),
        F.col("closed.lng").alias("alarm_end_lng"), F.col("closed.lat").alias("alarm_end_lat"),
    ]
    return out.select(*columns)


def thin_alarms(alarms: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Per vehicle and code an alarm is kept if it starts at least two hours after the last kept
    one; a document-control alarm if it is the first of its calendar day."""
    key = key or [*KEY, "illegal_type_code"]
    daily = F.col("illegal_type_code") == DOCUMENT_CONTROL
    rest = [c for c in alarms.columns if c not in key]
    # Both rules on one clock: for daily alarms a day counts as one thinning interval, so that
    # the first alarm of each day is exactly one interval or more after the one before.
    day_clock = timefn.day_number(F.col("start_sec")).cast("long") * THINNING_SECONDS
    clock = F.when(daily, day_clock).otherwise(F.col("start_sec"))
    # Of alarms at the same clock time only the first can be kept.
    first = alarms.groupBy(*key, clock.alias("_clock")).agg(
        F.min_by(F.struct(*rest), F.struct("start_sec", "start_event_id")).alias("_a")
    ).select(*key, "_clock", "_a.*")
    rule = ChainRule(gap=THINNING_SECONDS, other_label=False, reopen="same")
    kept = greedy_chain(first, key, rule, order=("_clock", "start_event_id"), width=30 * DAY)
    return kept.where(F.col("role") == "open").select(*alarms.columns)


def fence_candidates(tracks: DataFrame, rules: DataFrame) -> DataFrame:
    """One episode per code: from the first position that breaks a rule with the code to the
    next position that breaks no rule at all."""
    marked = with_violations(tracks, rules)
    rows = marked.select(*KEY, "t_sec", "event_id", "lng", "lat", F.explode_outer("violations").alias("_v")).select(
        *KEY, "t_sec", "event_id", "lng", "lat", "_v.*"
    )
    breaks = F.col("illegal_type_code").isNotNull()
    paired = episodes(
        rows, KEY, breaks, ~breaks, [*FENCE, "lng", "lat"], by=["illegal_type_code"],
    )
    return _candidates(paired, extra=FENCE)


def fence_alarms(tracks: DataFrame, rules: DataFrame) -> DataFrame:
    return thin_alarms(fence_candidates(tracks, rules))


def gps_incomplete_candidates(tracks: DataFrame) -> DataFrame:
    """Standing still, then moving again somewhere else."""
    speed = F.col("speed")
    paired = episodes(tracks, KEY, speed == 0, speed > 0, ["lng", "lat"])
    found = _candidates(paired, F.lit(GPS_INCOMPLETE))
    jump = geo.distance_m(
        F.col("alarm_end_lng"), F.col("alarm_end_lat"), F.col("alarm_start_lng"), F.col("alarm_start_lat")
    )
    return found.where(jump > GPS_JUMP_M)


def gps_incomplete_alarms(tracks: DataFrame) -> DataFrame:
    return thin_alarms(gps_incomplete_candidates(tracks))


def off_route_points(tracks: DataFrame, cards: DataFrame | None = None, radius_m: float = 500.0) -> DataFrame:
    """Positions of vehicles with a permit; ``off_route`` is false when a vertex of a permitted route is near. Routes come
    from the permits ``cards``, laid out once; without these from ``coords``, the text that a message of the bus bears,
    parsed for each position."""
    if cards is not None:
        return off_route(tracks.join(card_routes(cards).select(*KEY), KEY, "left_semi"), card_routes(cards), radius_m)
    permitted = tracks.where(F.col("register_card_state") == 1)
    routes = geo.route_vertices(F.col("coords"))
    return permitted.withColumn("off_route", geo.off_route(F.col("lng"), F.col("lat"), routes, radius_m))


def off_route_candidates(tracks: DataFrame, cards: DataFrame | None = None) -> DataFrame:
    points = off_route_points(tracks, cards).select(*KEY, "t_sec", "event_id", "lng", "lat", "off_route")
    off = F.col("off_route")
    return _candidates(episodes(points, KEY, off, ~off, ["lng", "lat"]), F.lit(OFF_ROUTE))


def off_route_alarms(tracks: DataFrame, cards: DataFrame | None = None) -> DataFrame:
    return thin_alarms(off_route_candidates(tracks, cards))


def no_register_alarms(tracks: DataFrame) -> DataFrame:
    """The first position of a vehicle without permit on each calendar day. An aggregate, so a
    hot vehicle is reduced before the shuffle."""
    rows = timed(tracks).where(F.col("register_card_state") == 0)
    first = F.min(F.struct("t_sec", "event_id", "lng", "lat")).alias("_f")
    per_day = rows.groupBy(*KEY, timefn.day_number(F.col("t_sec")).alias("_d")).agg(first)
    return per_day.select(
        *KEY, F.lit(NO_REGISTER_CARD).alias("illegal_type_code"), F.col("_f.t_sec").alias("start_sec"),
        F.col("_f.event_id").alias("start_event_id"), F.col("_f.lng").alias("alarm_start_lng"),
        F.col("_f.lat").alias("alarm_start_lat"),
    )


def illegal_disposal(tracks: DataFrame, sites: DataFrame, cards: DataFrame) -> DataFrame:
    """Alarms of positions near an audited disposal site that the vehicle has no permit for, the first such
    site by id, thinned like all alarms. The rule is inferred: the published job collects the permitted sites
    but raises nothing."""
    return thin_alarms(illegal_disposal_points(tracks, sites, cards))


def illegal_disposal_points(tracks: DataFrame, sites: DataFrame, cards: DataFrame) -> DataFrame:
    """One alarm row per offending position, as a stream needs it.

    Of sites at the same places the smallest id comes first, unless the vehicle has a permit for it; then the smallest
    without a permit. These are found per vehicle with permits, so a position carries its places, not all their sites."""
    rows = timed(tracks).select(*KEY, "t_sec", "event_id", "lng", "lat")
    places, members = together(audited_disposal(sites))
    near = with_near_ids(rows, places).where(F.size("near") > 0)
    ranked = members.withColumn("_rank", F.row_number().over(Window.partitionBy("dept_id", "group_id").orderBy("site_id")))
    allowed = enrich.allowed_disposal_sites(cards, sites).select("vehicle_id", F.col("disposal_site_id").alias("site_id"))
    taken = allowed.join(ranked, "site_id").groupBy(*KEY, "group_id").agg(
        F.array_sort(F.collect_set("_rank")).alias("_taken"))
    # the first rank that is not taken: all before it are
    before = F.size(F.filter("_taken", lambda rank, i: rank == i + 1))
    firsts = taken.select(*KEY, "group_id", (before + 1).alias("_rank")).join(ranked, ["dept_id", "group_id", "_rank"], "left")
    firsts = firsts.groupBy(*KEY).agg(F.collect_list(F.struct("group_id", "site_id")).alias("_firsts"))
    found = near.join(firsts, KEY, "left").withColumn("_firsts", F.coalesce("_firsts", F.array()))
    untouched = F.filter("near", lambda g: ~F.exists("_firsts", lambda f: f["group_id"] == g))
    others = F.transform(F.filter("_firsts", lambda f: F.array_contains("near", f["group_id"])), lambda f: f["site_id"])
    found = found.withColumn("site_id", F.array_min(F.concat(untouched, others)))
    return found.where(F.col("site_id").isNotNull()).select(
        *KEY, F.lit(ILLEGAL_DISPOSAL).alias("illegal_type_code"), F.col("t_sec").alias("start_sec"),
        F.col("event_id").alias("start_event_id"), F.col("lng").alias("alarm_start_lng"),
        F.col("lat").alias("alarm_start_lat"), "site_id",
    )


def enrich_alarms(
    alarms: DataFrame, scores: DataFrame, processed_at: Column, strict: bool = False,
    random_ids: bool = False,
) -> DataFrame:
    """Alarm rows ready for the alarm table: duration text, distance, scores, id, partition.

    The id is a digest of the alarm's key, so a repeated run writes the same ids; ``random_ids``
    gives a fresh one each time."""
    spent = F.col("end_sec") - F.col("start_sec")
    ends = [F.col(f"alarm_{e}_{c}") for e in ("start", "end") for c in ("lng", "lat")]
    complete = ends[0].isNotNull() & ends[1].isNotNull() & ends[2].isNotNull() & ends[3].isNotNull()
    ident = F.sha2(
        F.concat_ws("|", *[F.col(c).cast("string") for c in [*KEY, "illegal_type_code", "start_sec", "start_event_id"]]), 256
    )
    out = alarms.withColumns(
        {
            "interval_time": F.when(spent.isNotNull(), timefn.duration_text(spent, strict)),
            "interval_distance": F.when(complete, geo.distance_m(*ends)),
            "end_sec": F.coalesce("end_sec", "start_sec"),
            "uuid": F.uuid() if random_ids else ident,
            "scoring_year": F.year(processed_at),
            **timefn.partition_columns(processed_at),
        }
    )
    return enrich.alarm_scores(out, scores)
