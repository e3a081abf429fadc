"""Chunked operators against a plain walk over the positions, with chunks so small that most
episodes and links cross them, and with one vehicle that holds a third of all rows."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from haulwatch.operators import alarms, movement
from haulwatch.operators.chains import ChainRule, greedy_chain
from haulwatch.operators.ordered import episodes, untimed, with_neighbours
from haulwatch.streaming import machines

KEY = ["dept_id", "vehicle_id"]


def made_rows(seed, n=900, span=40000):
    """Positions on a few sites and on the road; vehicle 0 has a third of them. Times collide."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vehicle = 0 if rng.random() < 0.34 else rng.randrange(1, 12)
        site = rng.choice([None, None, 1, 2, 3])
        rows.append(
            (1, vehicle, rng.randrange(span), i, site, (1 if site == 1 else 2) if site else None,
             rng.choice([0.0, 0.0, 5.0, 20.0]), 113.6 + rng.randrange(3) * 0.03, 34.7)
        )
    return rows


SCHEMA = (
    "dept_id int, vehicle_id long, t_sec long, event_id long, site_id long, site_flag int, speed double, "
    "lng double, lat double"
)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def by_vehicle(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        out.setdefault(r[1], []).append(SimpleNamespace(**dict(zip(NAMES, r))))
    return out


def walk(rows, machine):
    out = []
    for vehicle, points in by_vehicle(rows).items():
        state = {}
        for p in points:
            out += [(vehicle, *emitted) for emitted in machine.step(state, p)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("strict", [False, True])
def test_trips_across_chunks(spark, monkeypatch, seed, strict):
    monkeypatch.setattr(movement, "DAY", 100)  # chunks of 700 seconds
    rows = made_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = movement.trips(df, strict, carry=()).select(
        "vehicle_id", "from_site_id", "from_site_flag", "from_site_inter_sec", "from_site_work_sec",
        "from_site_leave_sec", "to_site_id", "to_site_flag", "to_site_inter_sec",
    )
    want = walk(rows, machines.TripMachine(strict=strict))
    assert len(want) > 20
    assert sorted(map(tuple, got.collect()), key=repr) == want


@pytest.mark.parametrize("width", [500, 7200, 100000])
def test_thinning_across_chunks(spark, width):
    rng = random.Random(width)
    starts = [(1, rng.choice([0, 0, 1, 2]), "0110", t, i) for i, t in enumerate(rng.sample(range(200000), 600))]
    df = spark.createDataFrame(starts, "dept_id int, vehicle_id long, illegal_type_code string, start_sec long, start_event_id long")
    rule = ChainRule(gap=7200, other_label=False, reopen="same")
    links = greedy_chain(df, [*KEY, "illegal_type_code"], rule, order=("start_sec", "start_event_id"), width=width)
    got = sorted(tuple(r) for r in links.where("role = 'open'").select("vehicle_id", "start_sec").collect())
    want, last = [], {}
    for _, v, _, t, _ in sorted(starts, key=lambda s: s[3]):
        if v not in last or t - last[v] >= 7200:
            last[v] = t
            want.append((v, t))
    assert got == sorted(want)


@pytest.mark.parametrize("width", [300, 5000])
def test_episodes_across_chunks(spark, width):
    rows = made_rows(7)
    df = spark.createDataFrame(rows, SCHEMA)
    speed = F.col("speed")
    got = episodes(df, KEY, speed == 0, speed > 10, ["lng"], width=width).select(
        "vehicle_id", "opened.event_id", "closed.event_id"
    )
    want = []
    for vehicle, points in by_vehicle(rows).items():
        start = None
        for p in points:
            if p.speed == 0 and start is None:
                start = p.event_id
            elif p.speed > 10 and start is not None:
                want.append((vehicle, start, p.event_id))
                start = None
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_stops_and_dwell_across_chunks(spark, monkeypatch):
    rows = made_rows(11)
    df = spark.createDataFrame(rows, SCHEMA)
    got = movement.stop_episodes(df, gap=400, width=900).select("vehicle_id", "stop_sec", "start_sec")
    want = [(r[0], r[1], r[4]) for r in walk(rows, machines.StopMachine(gap=400))]
    assert sorted(map(tuple, got.collect())) == sorted(want) and want

    sites = spark.createDataFrame(
        [(1, i, 2, 113.6 + i * 0.03, 34.7, 0, "1") for i in range(2)]
        + [(1, 9, 2, 113.6, 34.7, 0, "0"), (1, 5, 2, 113.6, 34.7, 0, "1"), (1, 6, 2, 113.6, 34.7, 1, "1")],
        "dept_id int, site_id long, site_flag int, lng double, lat double, is_delete int, audit_state string",
    )
    near = [SimpleNamespace(**dict(zip(NAMES, r)), near=[i for i in (0, 1, 5) if abs(r[7] - 113.6 - i % 5 * 0.03) < 1e-9]) for r in rows]
    expected = []
    for vehicle in {r.vehicle_id for r in near}:
        state = {}
        for p in sorted((r for r in near if r.vehicle_id == vehicle), key=lambda r: (r.t_sec, r.event_id)):
            expected += [(vehicle, *e) for e in machines.DwellMachine().step(state, p)]
    for width in (60, 900, 86_400):  # two sites at one place, a third one deleted
        found = movement.inout_dwell(df, sites, width=width).select("vehicle_id", "site_id", "enter_sec", "exit_sec")
        assert sorted(map(tuple, found.collect())) == sorted(expected) and expected, width
    assert {site for _, site, *_ in expected} == {0, 1, 5}


def test_rows_without_a_time_change_nothing(spark):
    """Of a vehicle of its own and of one with other rows; they are what `untimed` gives."""
    rows = made_rows(5, n=300)
    bad = [(1, v, None, 5000 + v, 1, 1, 0.0, 113.6, 34.7) for v in (0, 3, 77)]
    df, more = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows + bad, SCHEMA)
    assert sorted(r.event_id for r in untimed(more).collect()) == [5000, 5003, 5077]

    def same(operator):
        got, want = (sorted(map(tuple, operator(d).collect()), key=repr) for d in (more, df))
        assert got == want and want

    same(lambda d: movement.trips(d, carry=()))
    same(lambda d: with_neighbours(d, KEY, ["event_id"], width=400))
    same(lambda d: episodes(d, KEY, F.col("speed") == 0, F.col("speed") > 10, ["lng"], width=400))
    same(lambda d: alarms.gps_incomplete_candidates(d))
    same(lambda d: alarms.no_register_alarms(d.withColumn("register_card_state", F.lit(0))))


def test_neighbours_across_chunks(spark):
    rows = made_rows(3, n=300)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.event_id: r for r in with_neighbours(df, KEY, ["event_id"], width=400).collect()}
    for points in by_vehicle(rows).values():
        for before, p, after in zip([None, *points], points, [*points[1:], None]):
            r = got[p.event_id]
            assert (r.prev.event_id if r.prev else None) == (before.event_id if before else None)
            assert (r.next.event_id if r.next else None) == (after.event_id if after else None)


def test_fence_episode_keeps_other_codes_open(spark):
    """A position that breaks another rule does not close an open alarm."""
    machine = machines.EpisodeMachine(codes="codes")
    points = [(0, ["0110"]), (100, ["0115"]), (500, [])]
    state, out = {}, []
    for i, (t, codes) in enumerate(points):
        out += machine.step(state, SimpleNamespace(t_sec=t, event_id=i, lng=1.0, lat=1.0, codes=codes))
    assert [(o[0], o[1]) for o in out] == [("0110", 0), ("0115", 100)]


def test_daily_rule_of_document_control(spark):
    rows = [(1, 1, "0119", t, i) for i, t in enumerate([10, 90000, 90001, 86400 * 3])]
    df = spark.createDataFrame(rows, "dept_id int, vehicle_id long, illegal_type_code string, start_sec long, start_event_id long")
    assert sorted(r.start_sec for r in alarms.thin_alarms(df).collect()) == [10, 90000, 86400 * 3]


def test_wide_rows_are_dealt_to_all_parts(spark, small):
    """Neighbours, chains and trips sort their rows in the parts that were asked for, not in one per core."""
    from haulwatch.plans.registry import QUERIES

    plan = QUERIES["trips"](spark, small)._jdf.queryExecution().executedPlan().toString()
    by_number = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert not any("REPARTITION_BY_COL" in line and "_row" not in line and "_halo" in line for line in plan.splitlines())
    assert len(by_number) >= 4


def test_positions_outside_are_sorted_without_what_trips_take_over(spark, monkeypatch):
    """While all positions are sorted, one outside all sites has its key, its order and a null; one inside has all."""
    seen, neighbours = [], movement.with_neighbours
    monkeypatch.setattr(movement, "with_neighbours", lambda df, *a: neighbours(seen.append(df) or df, *a))
    df = spark.createDataFrame(made_rows(3), SCHEMA).withColumn("vehicle_model_id", F.lit("16"))
    got = movement.trips(df, carry=("vehicle_model_id",))
    assert {r.load for r in got.collect()} == {19.32}
    row = {r._outside: r.asDict() for r in seen[0].collect()}
    filled = {c for c, v in row[True].items() if v is not None}
    assert filled == {*KEY, "t_sec", "event_id", "_outside"} and len(row[True]) == 6
    assert row[False]["_place"].vehicle_model_id == "16" and row[False]["_place"].site_id is not None
