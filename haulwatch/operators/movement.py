"""Trips, online time, stops, dwell visits and the current state of a vehicle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulwatch.functions import timefn
from haulwatch.operators.chains import ChainRule, greedy_chain
from haulwatch.operators.clean import empty_flag, load_by_model
from haulwatch.operators.ordered import DAY, timed, with_chunk, with_neighbours
from haulwatch.operators.proximity import audited_disposal, with_near_ids
from haulwatch.session import dealt

KEY = ["dept_id", "vehicle_id"]

TRIP_GAP_SECONDS = 360  # more than five whole minutes
STOP_GAP_SECONDS = 180
DWELL_SECONDS = 180


# What a trip takes over from the position that ends it.
TRIP_CARRY = (
    "vehicle_model_id", "enterprise_id", "enterprise_name", "car_card_number", "province_id", "city_id", "area_id",
)


def trips(sited: DataFrame, strict: bool = False, carry: tuple[str, ...] = TRIP_CARRY) -> DataFrame:
    """Trips from site to site out of positions with ``site_*`` columns.

    A stay opens at a position inside a site. It closes at the first position inside another
    site at least six minutes later, which gives a trip; the next position inside a site opens
    the next stay. Positions outside all sites do not end a stay; the first one gives the leave
    time. With ``strict`` they do: the open stay is replaced by the outside position, so the
    following trip has no origin (and is removed by :func:`clean.valid_trips`).

    ``carry`` names the columns a trip takes over; the load needs ``vehicle_model_id``."""
    site_cols = [c for c in sited.columns if c.startswith("site_")]
    more = list(carry)
    # No trip takes anything over from a position outside. Its columns are one null while all positions are sorted.
    outside = F.col("site_id").isNull()
    place = F.when(~outside, F.struct(*site_cols, *more)).alias("_place")
    rows = with_neighbours(
        sited.select(*KEY, "t_sec", "event_id", place, outside.alias("_outside")), KEY, ["t_sec", "_outside"])
    if strict:
        # Of consecutive outside positions only the last one can matter.
        kept = rows.where(~F.col("_outside") | ~F.col("next._outside"))
        kept = kept.withColumn("_left", F.lit(None).cast("long"))
    else:
        kept = rows.where(~F.col("_outside")).withColumn("_left", F.when(F.col("next._outside"), F.col("next.t_sec")))
    kept = kept.select(*KEY, "t_sec", "event_id", "_outside", "_left", "_place.*")
    rule = ChainRule(gap=TRIP_GAP_SECONDS, other_label=True, reopen="next")
    links = greedy_chain(kept, KEY, rule, label="site_id", reset="_outside", out="_left", width=7 * DAY)
    end = F.struct("t_sec", *site_cols, *more)
    pair = [*KEY, "link_t", "link_seq"]
    paired = dealt(links, *pair).groupBy(*pair).agg(
        F.max(F.when(F.col("role") == "open", end)).alias("o"),
        F.max(F.when(F.col("role") == "close", end)).alias("c"),
        F.max("worked_t").alias("from_site_work_sec"), F.max("leave_t").alias("from_site_leave_sec"),
    ).where(F.col("c").isNotNull())
    load = {"load": load_by_model(F.col("c.vehicle_model_id"))} if "vehicle_model_id" in more else {}
    out = paired.select(
        *KEY, *[F.col(f"c.{c}").alias(c) for c in more],
        *[F.col(f"o.{c}").alias(f"from_{c}") for c in site_cols],
        F.col("o.t_sec").alias("from_site_inter_sec"), "from_site_work_sec", "from_site_leave_sec",
        *[F.col(f"c.{c}").alias(f"to_{c}") for c in site_cols],
        F.col("c.t_sec").alias("to_site_inter_sec"),
        *[c.alias(n) for n, c in load.items()], empty_flag(F.col("o.site_flag")).alias("vehicle_empty"),
    )
    return out.withColumns({c[:-3] + "time": timefn.time_text(F.col(c)) for c in out.columns if c.endswith("_sec")})


def with_trip_dims(trips: DataFrame, sites: DataFrame, vehicles: DataFrame, enterprises: DataFrame) -> DataFrame:
    """Streamed trips, which know their sites by id, with the columns that :func:`trips` takes from the
    positions. Each table has one row per key."""
    out = trips
    for end in ("from", "to"):
        attrs = [c for c in sites.columns if c not in ("dept_id", "site_flag", "is_delete")]
        named = {c: f"{end}_{c}" if c.startswith("site_") else f"{end}_site_{c}" for c in attrs}
        dim = sites.select("dept_id", *[F.col(c).alias(n) for c, n in named.items()])
        out = out.join(dim, ["dept_id", f"{end}_site_id"], "left")
    known = vehicles.select(*KEY, "vehicle_model_id", "enterprise_id", "car_card_number")
    names = enterprises.select("dept_id", "enterprise_id", "enterprise_name", "province_id", "city_id", "area_id")
    out = out.join(known, KEY, "left").join(names, ["dept_id", "enterprise_id"], "left")
    return out.withColumns({
        "load": load_by_model(F.col("vehicle_model_id")),
        **{c[:-3] + "time": timefn.time_text(F.col(c)) for c in trips.columns if c.endswith("_sec")},
    })


def vehicle_online_time(tracks: DataFrame) -> DataFrame:
    """Seconds online today, per position.

    The running total grows by the time since the last position and starts again when it would
    exceed the seconds since midnight, which is exactly at the first position of a day. So the
    total is the time since the vehicle's first position of the day: an aggregate, not a fold.
    A position in the same second as an earlier one reports 0."""
    rows = tracks.where(F.col("t_sec").isNotNull()).withColumn("_day", timefn.day_number(F.col("t_sec")))
    first = rows.groupBy(*KEY, "_day").agg(F.min("t_sec").alias("_first"))
    second = Window.partitionBy(*KEY, "t_sec").orderBy("event_id")
    ranked = rows.withColumn("_n", F.row_number().over(second))
    online = F.when(F.col("_n") == 1, F.col("t_sec") - F.col("_first")).otherwise(F.lit(0))
    return (
        ranked.join(first, [*KEY, "_day"])
        .withColumns(
            {
                "online_time": online.cast("long"), "vehicle_status": F.lit(0),
                "online_status": F.when(F.col("speed") > 0, 1).otherwise(0),
            }
        )
        .drop("_day", "_first", "_n")
    )


def online_time_of_day(tracks: DataFrame) -> DataFrame:
    """Online seconds per vehicle and day: first to last position, one map-side aggregate."""
    rows = tracks.where(F.col("t_sec").isNotNull())
    return rows.groupBy(*KEY, timefn.day_number(F.col("t_sec")).alias("day")).agg(
        (F.max("t_sec") - F.min("t_sec")).alias("online_time"), F.count(F.lit(1)).alias("positions")
    )


def vehicle_current_state(tracks: DataFrame, known: DataFrame) -> DataFrame:
    """Snapshot rows replaced by the newest position of their vehicle. Vehicles that are not in
    the snapshot are not added; vehicles without a new position keep their row. Positions are read once and
    summed per vehicle and day on the map side."""
    state = F.struct("t_sec", "event_id", "lng", "lat", "speed")
    day = timefn.day_number(F.col("t_sec")).alias("day")
    days = tracks.where(F.col("t_sec").isNotNull()).groupBy(*KEY, day).agg(
        F.max(state).alias("_n"), (F.max("t_sec") - F.min("t_sec")).alias("online_time")
    )
    last = days.groupBy(*KEY).agg(F.max(F.struct("day", "_n", "online_time")).alias("_o"))
    fresh = last.select(*KEY, F.col("_o._n").alias("_n"), "_o").select(
        *KEY, "_n.t_sec", "_n.lng", "_n.lat", "_n.speed", F.col("_o.online_time").alias("online_time"),
        F.lit(0).alias("vehicle_status"), F.when(F.col("_n.speed") > 0, 1).otherwise(0).alias("online_status"),
    )
    return replace_known(known, fresh, KEY)


def replace_known(known: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """``known`` with the columns of ``fresh`` put over it where the key matches."""
    update = [c for c in fresh.columns if c not in keys]
    renamed = fresh.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in update])
    joined = known.join(renamed, keys, "left")
    out = [F.col(c) for c in known.columns if c not in update]
    for c in update:
        old = F.col(c) if c in known.columns else F.lit(None)
        out.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(old).alias(c))
    return joined.select(*out)


def stop_episodes(tracks: DataFrame, gap: int = STOP_GAP_SECONDS, width: int = DAY) -> DataFrame:
    """Stops that were seen through: standing from ``stop`` until the first moving position.

    A stop is followed while its positions are at most ``gap`` seconds apart and is reported when
    a moving position comes less than ``gap`` seconds after the last one. Whether a position starts, follows or ends a
    stop depends on the one before it, so a chunk also sees the last ``gap`` seconds of the chunk before."""
    speed = F.col("speed")
    # without nulls in the key both branches below read the same exchange
    placed = F.col("dept_id").isNotNull() & F.col("vehicle_id").isNotNull() & F.col("t_sec").isNotNull()
    rows = tracks.where((speed >= 0) & placed).select(
        *KEY, "t_sec", "event_id", "lng", "lat", (speed > 0).alias("_moving")
    )
    chunked = with_chunk(rows, width)
    late = F.pmod(F.col("t_sec"), F.lit(width)) >= width - gap
    copies = F.when(late, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    chunked = chunked.withColumn("_copy", F.explode(copies)).withColumn(
        "_chunk", F.col("_chunk") + F.col("_copy").cast("long")
    )
    chunk = [*KEY, "_chunk"]
    w = Window.partitionBy(*chunk).orderBy("t_sec", "event_id")
    seen = chunked.withColumn("_b", F.lag(F.struct("t_sec", "_moving")).over(w))
    since = F.col("t_sec") - F.col("_b.t_sec")
    standing_before = F.col("_b").isNotNull() & ~F.col("_b._moving")
    follows = F.coalesce(standing_before & (since <= gap), F.lit(False))
    starts = ~F.col("_moving") & ~follows & ~F.col("_copy")
    ends = F.col("_moving") & F.coalesce(standing_before & (since < gap), F.lit(False)) & ~F.col("_copy")
    place = F.struct("t_sec", "event_id", "lng", "lat")
    seen = seen.withColumns({"_start": F.when(starts, place), "_ends": ends})
    # a stop ends the last start before it: of its chunk, or else of the chunks before, one row for each of them
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = seen.withColumn("_open", F.last("_start", ignorenulls=True).over(so_far))
    last = seen.groupBy(*chunk).agg(F.max("_start").alias("_last"))
    across = Window.partitionBy(*KEY).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_before", F.last("_last", ignorenulls=True).over(across)).drop("_last")
    done = seen.where("_ends").join(carried, chunk, "left").withColumn("opened", F.coalesce("_open", "_before"))
    return done.where(F.col("opened").isNotNull()).select(
        *KEY, F.col("opened.t_sec").alias("stop_sec"), F.col("opened.lng").alias("stop_lng"),
        F.col("opened.lat").alias("stop_lat"), F.col("t_sec").alias("start_sec"), F.col("lng").alias("start_lng"),
        F.col("lat").alias("start_lat"),
    )


def inout_dwell(tracks: DataFrame, sites: DataFrame, seconds: int = DWELL_SECONDS, width: int = DAY) -> DataFrame:
    """Visits of disposal sites: (enter, exit) per vehicle and site.

    A visit is confirmed by a position inside more than ``seconds`` after the enter, and ends at
    the first position outside once the vehicle has stayed outside for more than ``seconds``.

    Positions are first compressed to runs near the same places, chunk by chunk; sites at one place share a run. Only
    the runs inside a place go on. How long the vehicle was outside afterwards follows from the run after it and the
    one before it came back. Long absences cut the runs of a place into segments. A segment longer than ``seconds``
    confirms and ends a visit; a shorter one leaves the visit pending, and the next segment then ends it."""
    disposal = audited_disposal(sites)
    if "is_delete" in disposal.columns:
        disposal = disposal.where(F.col("is_delete") == 0)
    places = disposal.groupBy("dept_id", "lng", "lat").agg(
        F.min("site_id").alias("site_id"), F.collect_set("site_id").alias("_sites"))
    rows = with_chunk(timed(tracks).select(*KEY, "t_sec", "event_id", "lng", "lat"), width)
    chunk = [*KEY, "_chunk"]
    # what a chunk has to know of the others: one row per chunk
    span = rows.groupBy(*chunk).agg(F.min("t_sec").alias("_from"), F.max("t_sec").alias("_to"))
    across = Window.partitionBy(*KEY).orderBy("_chunk")
    whole = Window.partitionBy(*KEY).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    span = span.select(
        *chunk, F.lag("_to").over(across).alias("_before"), F.lead("_from").over(across).alias("_after"),
        F.last("_to").over(whole).alias("_last"))
    near = with_near_ids(rows, places).select(*chunk, "t_sec", "event_id", F.array_sort("near").alias("near"))
    inside = Window.partitionBy(*chunk).orderBy("t_sec", "event_id")
    changed = ~F.coalesce(F.lag("near").over(inside) == F.col("near"), F.lit(False))
    run = F.sum(changed.cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = near.withColumn("_run", run)
    runs = near.groupBy(*chunk, "_run").agg(
        F.first("near").alias("near"), F.min("t_sec").alias("from"), F.max("t_sec").alias("to"))
    beside = Window.partitionBy(*chunk).orderBy("_run")
    runs = runs.withColumns({"came": F.lag("to").over(beside), "left": F.lead("from").over(beside)})
    runs = runs.where(F.size("near") > 0).join(span, chunk).select(
        *chunk, "_run", F.explode("near").alias("place"), "from", "to", F.coalesce("came", "_before").alias("came"),
        F.coalesce("left", "_after").alias("left"), F.col("_last"))
    pair = [*KEY, "place"]
    order = ["from", "_chunk", "_run"]
    visits = Window.partitionBy(*pair).orderBy(*order)
    back = F.lead(F.struct("from", "came")).over(visits)
    runs = runs.withColumn("_back", back)
    away = F.coalesce(F.col("_back.came"), F.col("_last")) - F.col("left")
    went_out = F.col("_back").isNull() | (F.col("left") != F.col("_back.from"))
    runs = runs.withColumn("_cut", F.coalesce(went_out & (away > seconds), F.lit(False)))
    so_far = visits.rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_segment", F.coalesce(F.sum(F.col("_cut").cast("int")).over(so_far), F.lit(0)))
    segments = runs.groupBy(*pair, "_segment").agg(
        F.min("from").alias("first_sec"), F.max("to").alias("last_sec"), F.max("_cut").alias("_closed"),
        F.max_by("left", F.struct(*order)).alias("exit_sec")).where("_closed")
    w = Window.partitionBy(*pair).orderBy("_segment")
    long = F.col("last_sec") - F.col("first_sec") > seconds
    ranked = segments.withColumns({"_n": F.row_number().over(w), "_long": long, "_before": F.lag("first_sec").over(w)})
    last_long = F.max(F.when(F.col("_long"), F.col("_n"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    pending = (F.col("_n") - 1 - F.coalesce(last_long, F.lit(0))) % 2 == 1
    ranked = ranked.withColumn("_pending", pending)
    enter = F.when(F.col("_pending"), F.col("_before")).otherwise(F.col("first_sec"))
    found = ranked.where(F.col("_long") | F.col("_pending")).select(*pair, enter.alias("enter_sec"), "exit_sec")
    sites_of = places.select("dept_id", F.col("site_id").alias("place"), "_sites")
    return found.join(sites_of, ["dept_id", "place"]).select(
        *KEY, F.explode("_sites").alias("site_id"), "enter_sec", "exit_sec")


def hourly_track_counts(tracks: DataFrame, late: str | None = None) -> DataFrame:
    """Positions and summed speed per department and hour. On a stream, ``late`` is how far the
    watermark stays behind; hours are final once it has passed them."""
    rows = tracks.withColumn("_at", F.timestamp_seconds("t_sec"))
    if late is not None:
        rows = rows.withWatermark("_at", late)
    return rows.groupBy("dept_id", F.window("_at", "1 hour").alias("_w")).agg(
        F.count(F.lit(1)).alias("positions"), F.sum("speed").alias("speed_sum")
    ).select("dept_id", F.unix_seconds("_w.start").alias("hour_sec"), "positions", "speed_sum")
