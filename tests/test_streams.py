"""Streams give the rows of the batch operators, whatever the cuts between micro-batches."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haulwatch.operators import alarms, clean, enrich, movement, proximity
from haulwatch.operators.asof import as_of
from haulwatch.plans import streams
from haulwatch.sources import messages, schemas
from haulwatch.sources.derived import view
from haulwatch.streaming import machines, sinks
from haulwatch.streaming.dims import RefreshedDim, per_batch
from haulwatch.streaming.stateful import run_machine, split_late

N_FILES = 3
#: Files come in the order of time, and with the last one everything is behind the watermark.
IN_ORDER = {"allowance": "0 seconds"}


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def tracks(spark, small):
    return view(spark, small, "v_track").where(F.col("lat") > 20)


@pytest.fixture(scope="module")
def in_order(spark, tracks, tmp_path_factory):
    """Positions in files by time, read one file per micro-batch in this order."""
    path = str(tmp_path_factory.mktemp("in_order"))
    low, high = tracks.agg(F.min("t_sec"), F.max("t_sec")).first()
    width = (high - low) // N_FILES + 1
    for i in range(N_FILES):
        part = tracks.where(F.floor((F.col("t_sec") - low) / width) == i).coalesce(1)
        target = f"{path}/part{i}"
        part.write.parquet(target)
        for file in glob.glob(f"{target}/*.parquet"):
            os.utime(file, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    return path


def stream(spark, path, schema):
    return messages.read_file_stream(spark, f"{path}/*", schema, files_per_trigger=1)


def run(spark, df, tmp_path, name="out", ckpt="ckpt"):
    out = f"{tmp_path}/{name}"
    query = (
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/{ckpt}")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batches = query.lastProgress["batchId"] if query.lastProgress else None
    return spark.read.schema(df.schema).parquet(out), batches


def same(streamed, batch, columns):
    def rows(df):
        found = df.select(*columns).collect()
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in found), key=repr)

    got, want = rows(streamed), rows(batch)
    assert want, "the batch operator found nothing"
    assert got == want


KEY = ["dept_id", "vehicle_id"]
ALARM = [*KEY, "illegal_type_code", "start_sec", "start_event_id", "alarm_start_lng", "end_sec", "alarm_end_lat"]
TRIP = [*KEY, "from_site_id", "from_site_inter_sec", "from_site_work_sec", "from_site_leave_sec", "to_site_id",
        "to_site_inter_sec", "vehicle_empty"]


def routed(df, cards):
    return enrich.with_register_card(df, cards)


@pytest.mark.parametrize(
    "name", ["trips", "trips_strict", "fence", "gps", "route", "permit", "online", "stops", "dwell", "illegal"]
)
def test_stream_equals_batch(spark, small, medium, tracks, in_order, tmp_path, name):
    sites, rules = view(spark, small, "v_site"), view(spark, small, "v_fence_rule")
    cards = view(spark, medium, "v_register_card")
    live = stream(spark, in_order, tracks.schema)
    batch = clean.admitted(tracks)
    if name.startswith("trips"):
        strict = name == "trips_strict"
        got = streams.trips(live, sites, strict, **IN_ORDER)
        want, columns = movement.trips(proximity.with_site(batch, sites), strict, carry=()), TRIP
    elif name == "fence":
        got, want = streams.fence_alarms(live, rules, **IN_ORDER), alarms.fence_alarms(batch, rules)
        columns = [*ALARM, *alarms.FENCE]
    elif name == "gps":
        got, want = streams.gps_incomplete_alarms(live, **IN_ORDER), alarms.gps_incomplete_alarms(batch)
        columns = ALARM
    elif name == "route":
        got = streams.off_route_alarms(live, cards, **IN_ORDER)
        want = alarms.off_route_alarms(routed(batch, cards))
        columns = ALARM
    elif name == "permit":
        got, want = streams.no_register_alarms(live, **IN_ORDER), alarms.no_register_alarms(batch)
        columns = [*KEY, "start_sec", "start_event_id", "alarm_start_lng"]
    elif name == "online":
        got, want = streams.online_time(live, **IN_ORDER), movement.vehicle_online_time(batch)
        columns = [*KEY, "event_id", "online_time", "online_status"]
    elif name == "stops":
        got, want = streams.stops(live, 36000, **IN_ORDER), movement.stop_episodes(batch, 36000)
        columns = [*KEY, "stop_sec", "start_sec", "start_lng"]
    elif name == "dwell":
        got, want = streams.dwell(live, sites, **IN_ORDER), movement.inout_dwell(batch, sites)
        columns = [*KEY, "site_id", "enter_sec", "exit_sec"]
    else:
        got, want = streams.illegal_disposal(live, sites, cards, **IN_ORDER), alarms.illegal_disposal(batch, sites, cards)
        columns = [*KEY, "start_sec", "start_event_id", "site_id"]
    done, last_batch = run(spark, got, tmp_path)
    assert last_batch >= 2, "needs several micro-batches"
    same(done, want, columns)


def test_trip_table_from_the_bus(spark, small, medium, in_order, tracks, tmp_path):
    """All columns of the trip table, from the stream and from the batch operator."""
    sites, vehicles, firms = (view(spark, f, n) for f, n in (
        (small, "v_site"), (medium, "v_vehicle"), (small, "v_enterprise")))
    at = F.expr("TIMESTAMP_NTZ'2024-01-31 07:05:09'")
    got = streams.trip_table(stream(spark, in_order, tracks.schema), sites, vehicles, firms, at, **IN_ORDER)
    known = vehicles.select(*KEY, "vehicle_model_id", "car_card_number", "enterprise_id")
    sited = proximity.with_site(clean.admitted(tracks), sites).join(known, KEY, "left").join(
        firms, ["dept_id", "enterprise_id"], "left")
    want = clean.trip_table_row(clean.valid_trips(movement.trips(sited, strict=True)), at)
    done, _ = run(spark, got, tmp_path)
    same(done, want, want.columns)
    assert done.where("province_id is not null and s_site_city_id is not null and load > 0").count()


def test_bus_messages_feed_the_stateful_jobs(spark, tracks, tmp_path):
    """JSON of the bus, with a time as text, some of it no time."""
    text = F.when(F.col("event_id") % 50 == 0, "2024-13-45 00:00:00").otherwise(
        F.date_format(F.timestamp_seconds("t_sec"), "yyyy-MM-dd HH:mm:ss"))
    sent = messages.to_json(tracks.withColumn("time", text).drop("t_sec", "ts", "event_id")).dropDuplicates(["value"])
    bus = messages.parse_bus(sent, StructType.fromDDL(schemas.BUS))
    assert bus.where("t_sec is null").count() and bus.select("event_id").distinct().count() == sent.count()
    sent.coalesce(1).write.parquet(f"{tmp_path}/in")
    live = messages.parse_bus(stream(spark, f"{tmp_path}/in", sent.schema), StructType.fromDDL(schemas.BUS))
    done, _ = run(spark, streams.gps_incomplete_alarms(live, **IN_ORDER), tmp_path)
    same(done, alarms.gps_incomplete_alarms(clean.admitted(bus)), ALARM)


def test_checkpoint_restart_adds_nothing(spark, small, tracks, in_order, tmp_path):
    live = lambda: streams.gps_incomplete_alarms(stream(spark, in_order, tracks.schema), **IN_ORDER)
    first = run(spark, live(), tmp_path)[0].count()
    assert run(spark, live(), tmp_path)[0].count() == first > 0


def files(df, path, by, n):
    """Rows in n files by a column, read one per micro-batch in this order."""
    for i in range(n):
        df.where(F.col(by) == i).drop(by).coalesce(1).write.parquet(f"{path}/part{i}")
        for file in glob.glob(f"{path}/part{i}/*.parquet"):
            os.utime(file, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    return path


def test_late_rows_are_reported(spark, tracks, tmp_path):
    """A file with older positions after a file with newer ones changes nothing."""
    cut = tracks.approxQuantile("t_sec", [0.5], 0.0)[0]
    older = F.coalesce(F.col("t_sec") < cut, F.lit(False)).cast("int")
    path = files(tracks.withColumn("old", older), f"{tmp_path}/late", "old", 2)
    both, _ = run(spark, streams.online_time(stream(spark, path, tracks.schema), report_late=True, **IN_ORDER), tmp_path)
    done, late = split_late(both, KEY)
    newer = clean.admitted(tracks).where(F.col("t_sec") >= cut)
    same(done, movement.vehicle_online_time(newer), [*KEY, "event_id", "online_time"])
    reason = F.when(F.col("t_sec").isNull(), "untimed").otherwise("late").alias("reason")
    left = clean.admitted(tracks).where((F.col("t_sec") < cut) | F.col("t_sec").isNull()).select("*", reason)
    same(late, left, [*KEY, "reason", "t_sec", "event_id"])
    assert left.select("reason").distinct().count() == 2


@pytest.mark.parametrize("cuts", [2, 5])
def test_order_of_arrival_makes_no_difference(spark, tracks, tmp_path, cuts):
    """Positions shuffled within the allowance give what sorted ones give, whatever the micro-batches."""
    low, high = tracks.agg(F.min("t_sec"), F.max("t_sec")).first()
    width, hours = (high - low) // cuts + 1, 5 * 3600
    shuffled = F.least(F.floor((F.col("t_sec") - low + F.pmod(F.xxhash64("event_id"), F.lit(hours))) / width), F.lit(cuts - 1))
    end = [(10**9, v, 0, high + 2 * hours) for v in range(1)]  # a last position lets the watermark pass all others
    closing = spark.createDataFrame(end, "event_id long, vehicle_id long, dept_id int, t_sec long")
    for name, kind in tracks.dtypes:
        if name not in closing.columns:
            closing = closing.withColumn(name, F.lit("1" if kind == "string" else None).cast(kind))
    rows = tracks.where("t_sec is not null").withColumn("n", shuffled)
    rows = rows.unionByName(closing.select(*tracks.columns).withColumn("n", F.lit(cuts).cast("long")))
    path = files(rows, f"{tmp_path}/in", "n", cuts + 1)
    live = streams.stops(stream(spark, path, tracks.schema), 36000, allowance=f"{hours} seconds", report_late=True)
    both, batches = run(spark, live, tmp_path)
    done, late = split_late(both, KEY)
    assert batches >= cuts and late.count() == 0
    same(done, movement.stop_episodes(clean.admitted(tracks), 36000), [*KEY, "stop_sec", "start_sec", "start_lng"])


def test_state_of_silent_vehicles_goes(spark, tmp_path):
    """A stop is forgotten when the watermark has passed its last position by the gap; the vehicle's key is gone."""
    places = [(1, 0, 0.0), (1, 100, 0.0), (2, 150, 0.0), (3, 5_000, 0.0), (3, 9_000, 0.0), (1, 9_050, 4.0)]
    rows = spark.createDataFrame([(0, v, i, t, s, 113.6, 34.7, 0 if t < 9_000 else 1) for i, (v, t, s) in enumerate(places)],
                                 "dept_id int, vehicle_id long, event_id long, t_sec long, speed double, lng double, lat double, n int")
    path = files(rows, f"{tmp_path}/in", "n", 2)
    live = run_machine(stream(spark, path, rows.drop("n").schema), machines.StopMachine(), KEY, "0 seconds")
    query = live.writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # vehicles 1 and 2 are gone after the first file; of the second one 3 stands and 1 moves on
    assert kept[0] == 3 and kept[-1] == 1
    assert spark.read.schema(live.schema).parquet(f"{tmp_path}/out").count() == 0


def test_repeated_positions(spark, tracks, tmp_path):
    """A position delivered twice counts once; the second is reported."""
    rows = tracks.where("t_sec is not null").limit(50).withColumn("n", F.lit(0))
    path = files(rows.unionByName(rows), f"{tmp_path}/in", "n", 1)
    both, _ = run(spark, streams.online_time(stream(spark, path, tracks.schema), report_late=True, **IN_ORDER), tmp_path)
    done, late = split_late(both, KEY)
    admitted = clean.admitted(rows)
    same(done, movement.vehicle_online_time(admitted), [*KEY, "event_id", "online_time"])
    assert [r["reason"] for r in late.select("reason").distinct().collect()] == ["repeated"]
    assert late.count() == admitted.count()


def test_hourly_counts_with_watermark(spark, tracks, in_order, tmp_path):
    counts = movement.hourly_track_counts(stream(spark, in_order, tracks.schema), "1 hour")
    done, _ = run(spark, counts, tmp_path)
    want = {tuple(r) for r in movement.hourly_track_counts(tracks).select("dept_id", "hour_sec", "positions").collect()}
    got = [tuple(r) for r in done.select("dept_id", "hour_sec", "positions").collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) > len(want) * 0.8


STATE = "dept_id int, vehicle_id long, t_sec long, event_id long, speed double"


@pytest.mark.parametrize("every", [1, 2, 3, 20])
def test_current_state_survives_replay(spark, small, tracks, tmp_path, every):
    known = view(spark, "/root/testdata/sf0.01", "v_vehicle").select(*KEY, "car_card_number").cache()
    table = sinks.StateTable(f"{tmp_path}/state", KEY, ["t_sec", "event_id"], STATE, buckets=4, compact_every=every)
    table.create(known)
    rows = clean.admitted(tracks).where("t_sec is not null").select(*KEY, "t_sec", "event_id", "speed").cache()

    def state(batch_id):
        return {tuple(r) for r in table.read(spark, batch_id).select(*KEY, "car_card_number", "t_sec", "event_id").collect()}

    seen = None
    for batch_id in (2, 0, 3, 1, 4):  # older positions come after newer ones
        part = rows.where(F.col("event_id") % 5 == batch_id)
        seen = part if seen is None else seen.unionByName(part)
    newest = seen.groupBy(*KEY).agg(F.max(F.struct("t_sec", "event_id")).alias("n")).select(*KEY, "n.*")
    want = {tuple(r) for r in known.join(newest, KEY, "left").collect()}
    for batch_id, part in enumerate((2, 0, 3, 1, 4)):
        changed = rows.where(F.col("event_id") % 5 == part)
        for _ in range(2):  # every batch is replayed
            table.update(changed, batch_id)
            now = state(batch_id)
        keys = changed.select(*KEY).distinct().count()
        assert spark.read.parquet(f"{tmp_path}/state/log/batch={batch_id}").count() == keys
        assert now == state(batch_id) and len(now) == known.count()
    assert now == want and len(want - {tuple(r) + (None, None) for r in known.collect()}) > 0
    logs, snapshots = (len(os.listdir(f"{tmp_path}/state/{kind}")) for kind in ("log", "snapshot"))
    assert logs <= min(5, 2 * every) and snapshots <= 2


def test_documents_replay(spark, tracks, tmp_path):
    for batch_id in (0, 1, 1):
        sinks.write_documents(tracks.drop("ts").where(F.col("event_id") % 2 == batch_id), f"{tmp_path}/d", "event_id", batch_id)
    assert spark.read.json(f"{tmp_path}/d").count() == tracks.count()


@pytest.mark.parametrize("by", [[], ["dept_id", "manage_state"]])
def test_batch_table_replay(spark, tracks, tmp_path, by):
    table = sinks.BatchTable(f"{tmp_path}/t", by)
    for batch_id in (0, 1, 1):
        table.write(tracks.where(F.col("event_id") % 2 == batch_id), batch_id)
    assert table.read(spark).count() == tracks.count()


def test_dimension_is_read_again(spark, small, tracks, in_order, tmp_path):
    now = [0.0]
    versions = [view(spark, small, "v_vehicle").select("vehicle_id", F.lit(i).alias("version")) for i in (1, 2)]
    dim = RefreshedDim(lambda: versions[0 if now[0] < 3600 else 1], 3600, lambda: now[0])
    seen = []

    def write(df, batch_id):
        seen.append({r[0] for r in df.select("version").distinct().collect()})
        now[0] += 2000

    step = per_batch(lambda batch, dim: batch.join(dim, "vehicle_id"), write, dim=dim)
    query = stream(spark, in_order, tracks.schema).writeStream.foreachBatch(step).option(
        "checkpointLocation", f"{tmp_path}/c"
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    assert seen[0] == {1} and seen[-1] == {2} and dim.reads == 2


def plain_as_of(rows, versions):
    out = []
    for i, key, t in rows:
        best = max((v for v in versions if v[0] == key and t is not None and v[1] <= t), key=lambda v: (v[1], v[3]), default=None)
        out.append((i, key, t, None if best is None or (best[2] is not None and t >= best[2]) else best[3]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [1, 7, 50, 10**6])
def test_as_of(spark, width):
    """Chunks of any width, a key with most rows, versions at the second of a row, gaps, missing keys and times."""
    import random

    rng = random.Random(width)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([*range(60), None])) for i in range(400)]
    versions = [(key, start, None if rng.random() < 0.6 else start + rng.randint(0, 20), f"v{n}")
                for n, (key, start) in enumerate((rng.randint(1, 4), rng.randint(0, 55)) for _ in range(25))]
    got = as_of(spark.createDataFrame(rows, "i int, k int, t_sec long"), spark.createDataFrame(
        versions, "k int, valid_from long, valid_to long, name string").select("k", "valid_from", "name", "valid_to"),
        ["k"], valid_to="valid_to", width=width)
    # of versions with the same start the largest row holds, and rows are compared by name first
    assert sorted((tuple(r) for r in got.select("i", "k", "t_sec", "name").collect()), key=repr) == plain_as_of(rows, versions)


def test_as_of_without_rows_or_versions(spark):
    rows = spark.createDataFrame([(1, 5)], "k int, t_sec long")
    none = spark.createDataFrame([], "k int, valid_from long, name string")
    assert [tuple(r) for r in as_of(rows, none, ["k"]).collect()] == [(1, 5, None, None)]
    assert as_of(rows.limit(0), none, ["k"]).count() == 0


@pytest.mark.parametrize("buckets", [1, 3])
def test_vehicles_share_a_state(spark, tracks, in_order, tmp_path, buckets):
    """A state holds the vehicles of a bucket, however many there are, and keeps them apart."""
    live = stream(spark, in_order, tracks.schema)
    stops = run_machine(clean.admitted(live), machines.StopMachine(gap=36000), KEY, "0 seconds", buckets=buckets)
    query = stops.writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(kept) <= buckets < tracks.select(*KEY).distinct().count()
    same(spark.read.schema(stops.schema).parquet(f"{tmp_path}/out"), movement.stop_episodes(clean.admitted(tracks), 36000),
         [*KEY, "stop_sec", "start_sec", "start_lng"])


def test_large_ids_beside_late_positions(spark, tmp_path):
    """Whole numbers stay exact in a bucket that also reports positions without any."""
    big = 2**60 + 1
    places = [(1, big, 1_000, 0.0, 0), (2, 2, 9_000, 1.0, 0), (1, 3, 500, 0.0, 1), (2, big + 2, 99_000, 1.0, 1)]
    rows = spark.createDataFrame([(0, v, i, t, s, 113.6, 34.7, n) for v, i, t, s, n in places],
                                 "dept_id int, vehicle_id long, event_id long, t_sec long, speed double, lng double, lat double, n int")
    path = files(rows, f"{tmp_path}/in", "n", 2)
    live = run_machine(stream(spark, path, rows.drop("n").schema), machines.OnlineMachine(), KEY, "0 seconds", True, buckets=1)
    done, late = split_late(run(spark, live, tmp_path)[0], KEY)
    assert sorted(r.event_id for r in done.collect()) == [2, big, big + 2]
    assert [(r.vehicle_id, r.event_id, r.reason) for r in late.collect()] == [(1, 3, "late")]


def test_dwell_of_sites_at_one_place(spark, tmp_path):
    """Sites at one place are one visit until it is over; one that has a second place is followed for itself."""
    at = {"A": (113.6, 34.7), "B": (113.7, 34.7)}
    sites = spark.createDataFrame([(s, 0, 2, 0, "1", *at[p]) for s, p in ((5, "A"), (6, "A"), (7, "B"), (9, "A"), (9, "B"))],
                                  "site_id long, dept_id int, site_flag int, is_delete int, audit_state string, lng double, lat double")
    way = [("A", 100), ("A", 300), ("B", 400), ("B", 800), (None, 900), (None, 1_300)]
    rows = spark.createDataFrame([(0, 1, i, t, *at.get(p, (113.8, 34.7)), "1", "1", 0) for i, (p, t) in enumerate(way)],
                                 "dept_id int, vehicle_id long, event_id long, t_sec long, lng double, lat double, manage_state string, audit_state string, n int")
    path = files(rows, f"{tmp_path}/in", "n", 1)
    live = streams.dwell(stream(spark, path, rows.drop("n").schema), sites, **IN_ORDER)
    done, _ = run(spark, live, tmp_path)
    assert sorted((r.site_id, r.enter_sec, r.exit_sec) for r in done.collect()) == [
        (5, 100, 400), (6, 100, 400), (7, 400, 900), (9, 100, 900)]
    places, members = proximity.together(sites)
    assert sorted(r.site_id for r in places.collect()) == [5, 7, 9, 9]
    assert sorted((r.group_id, r.site_id) for r in members.collect()) == [(5, 5), (5, 6), (7, 7), (9, 9)]
