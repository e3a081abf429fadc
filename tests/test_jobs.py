"""The batch jobs and the hops of the enrichment path, end to end."""

import datetime as dt

from pyspark.sql import functions as F

from haulwatch.operators import clean, tonnage, violations
from haulwatch.plans import jobs
from haulwatch.sources import messages, tables
from haulwatch.sources.derived import view
from haulwatch.streaming import sinks

AS_OF = dt.date(2024, 1, 15)


def dims(spark, folder):
    return jobs.Dims(**{n: view(spark, folder, f"v_{n}") for n in jobs.Dims.__dataclass_fields__})


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_daily_tonnage_twice(spark, small, tmp_path):
    trips = view(spark, small, "v_trip")
    table = trips.withColumns({"month_id": F.lit("2024-01"), "day_id": F.when(F.col("l_linenumber") < 4, "14").otherwise("13")})
    before = view(spark, small, "v_amount").withColumns({"month_id": F.lit("2024-01"), "day_id": F.lit("14")})
    names = view(spark, small, "v_area_name")
    for _ in range(2):
        jobs.daily_tonnage(table, names, before, AS_OF, f"{tmp_path}/stats", f"{tmp_path}/amount")
    yesterday = trips.where("l_linenumber < 4")
    daily = tonnage.build_disposal_daily(yesterday)
    stored = spark.read.parquet(f"{tmp_path}/stats").where("day_id = '14'")
    assert rows(stored, "site_id", "dept_id", "build_count") == rows(daily, "site_id", "dept_id", "build_count")
    want = tonnage.cumulative_amount(daily, names, before)
    got = spark.read.parquet(f"{tmp_path}/amount").where("day_id = '15'")
    assert rows(got, "site_id", "dept_id", "build_count", "disposal_count") == rows(
        want, "site_id", "dept_id", "build_count", "disposal_count"
    )


def test_daily_scores(spark, small, tmp_path):
    jobs.daily_scores(view(spark, small, "v_illegal"), AS_OF, str(tmp_path))
    detail = violations.scoring_detail(view(spark, small, "v_illegal"))
    for name, operator in jobs.SCORE_TABLES.items():
        assert spark.read.parquet(f"{tmp_path}/{name}").where("day_id = '15'").count() == operator(detail).count(), name


def test_frames_to_bus(spark, small, tmp_path):
    vehicles = view(spark, small, "v_vehicle").withColumn(
        "terminal_id", F.lpad(F.col("vehicle_id").cast("string"), 11, "0")
    )
    view(spark, small, "v_frame").write.parquet(f"{tmp_path}/frames")
    frames = spark.read.parquet(f"{tmp_path}/frames")
    bus = jobs.frames_to_bus(frames, vehicles, dims(spark, small), AS_OF)
    got = bus.select("event_id", "vehicle_id", "enterprise_name", "region_id", "register_card_state", "lat").collect()
    assert got and all(r.lat > 20 and r.enterprise_name for r in got)
    assert {c.split()[0] for c in "devid time point speed service_state transport_card_state coords".split()} <= set(bus.columns)
    good = frames.where("event_id % 40 not in (1, 2, 3, 4, 5)")
    positions = jobs.frames_to_positions(good, vehicles, AS_OF)
    second = jobs.positions_to_bus(messages.to_json(positions), dims(spark, small))
    # The strict hop also drops positions that are too fast to be plausible.
    slow = bus.where("speed < 100")
    assert rows(second, "vehicle_id", "time", "enterprise_name") == rows(slow, "vehicle_id", "time", "enterprise_name")


def test_plates_to_bus(spark, small):
    raw = view(spark, small, "v_raw_track")
    stamp = F.date_format(F.timestamp_seconds("t_sec"), "yyyy-MM-dd HH:mm:ss")
    values = messages.to_json(raw.select(F.col("plate").alias("devid"), stamp.alias("time"), "lng", "lat", "speed"))
    vehicles = view(spark, small, "v_vehicle")
    positions = jobs.plates_to_positions(values, vehicles, AS_OF)
    expected = clean.on_day(raw, AS_OF).join(vehicles, raw["plate"] == vehicles["car_card_number"])
    assert positions.count() == expected.count() > 0
    assert all(r.devid.startswith("T") for r in positions.select("devid").collect())
    bus = jobs.plates_to_bus(values, vehicles, dims(spark, small), AS_OF)
    assert 0 < bus.count() <= positions.count()


def test_trip_messages_to_rows(spark, small):
    from haulwatch.plans.registry import _trips

    trips = _trips(spark, small, strict=True)
    out = jobs.trip_messages_to_rows(messages.to_json(trips), trips.schema, F.expr("TIMESTAMP_NTZ'2024-01-31 07:05:09'"))
    assert len(out.columns) == 64 and out.columns[-3:] == ["month_id", "day_id", "hour_id"]
    assert out.count() == clean.valid_trips(trips).count()


def test_latest_per_key_and_partition(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, "c")], "k int, v int, x string")
    assert rows(tables.latest_per_key(df, ["k"], ["v"]), "k", "x") == [(1, None), (2, "c")]


def test_overwrite_dynamic(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    sinks.overwrite_partitions(df, f"{tmp_path}/t", ["p"])
    sinks.overwrite_partitions(spark.createDataFrame([("a", 5)], "p string, v int"), f"{tmp_path}/t", ["p"])
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "p", "v") == [("a", 5), ("b", 2)]


class Recorder:
    """Stands in for a session's reader and notes what is set."""

    def __init__(self):
        self.seen = {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def load(self):
        return self.seen


def test_options_of_the_database_scan():
    scan = lambda **more: tables.read_jdbc(Recorder(), "jdbc:x://h/db", "vehicle", **more)
    plain = {"format": "jdbc", "url": "jdbc:x://h/db", "dbtable": "vehicle", "fetchsize": 10000}
    assert scan() == plain
    assert scan(user="u", password="p", driver="d", fetch_rows=7) == plain | {
        "user": "u", "password": "p", "driver": "d", "fetchsize": 7}
    assert scan(partition_column="id", bounds=(1, 900), partitions=8) == plain | {
        "partitionColumn": "id", "lowerBound": 1, "upperBound": 900, "numPartitions": 8}
    # a parallel scan needs its bounds
    assert scan(partition_column="id", partitions=8) == plain


def test_tonnage_is_computed_once(spark, small, monkeypatch):
    """What is written three times is read from where it was stored."""
    from haulwatch.plans.registry import QUERIES

    plans, write = [], sinks.overwrite_static

    def seen(df, path, values):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, path, values)

    monkeypatch.setattr(sinks, "overwrite_static", seen)
    assert QUERIES["overwrite_partition"](spark, small).count() == 2
    assert len(plans) == 3 and not any("Join" in p or "Aggregate" in p for p in plans)


def test_rank_levels_from_two_shuffles(spark):
    """The six levels equal the rank tables, with vehicles and names missing; no row is copied per level."""
    made = []
    for i in range(300):
        vehicle = None if i % 11 == 0 else i % 7
        made.append((vehicle, None if i % 5 == 0 else f"car {i % 7}", i % 4, f"firm {i % 3}", f"0{i % 3}", None if i % 3 else "x",
                     None if i % 13 == 0 else float(i), float(i % 9), str(i % 2), None if i % 17 == 0 else "c", "a", i % 2))
    detail = spark.createDataFrame(made, "vehicle_id long, car_card_number string, transport_enterprise_id long, enterprise_name string, "
                                   "illegal_id string, illegal_name string, enterprise_final_score double, "
                                   "vehicle_driver_final_score double, province_id string, city_id string, area_id string, dept_id int")
    found = violations.rank_grouping_sets(detail)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    tables_ = {"type": violations.rank_by_type, "enterprise": violations.rank_by_enterprise,
               "enterprise_type": violations.rank_by_enterprise_type, "vehicle": violations.rank_by_vehicle,
               "vehicle_type": violations.rank_by_vehicle_type, "total": violations.rank_total}
    for level, operator in tables_.items():
        want = operator(detail)
        got = found.where(F.col("level") == level)
        assert rows(got, *want.columns) == rows(want, *want.columns)
    firms = found.where("level = 'enterprise_type'").groupBy().agg(F.max("illegal_vehicle_count")).first()[0]
    assert firms and found.where("level = 'total'").select(F.max("illegal_vehicle_count")).first()[0] == 7
