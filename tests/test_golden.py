"""Known frames, times and coordinates; shapes of plans."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haulwatch.functions import geo, timefn
from haulwatch.sources import frames
from haulwatch.sources.derived import view

FRAME = (
    "020000380647460535020a4500000000810c00030220aa0306cf27bf00420000013121011316300501040001095c"
    "030200002504000000102b0400006d5130011b31011907"
)


def decoded(spark, texts, **kw):
    return frames.decode_frames(spark.createDataFrame([(t,) for t in texts], "frame string"), **kw)


def test_golden_frame(spark):
    row = decoded(spark, [FRAME])[0].first()
    assert (row.header.msg_id, row.header.body_length, row.header.has_sub_package) == (0x0200, 56, False)
    assert (row.header.terminal_phone, row.header.flow_id) == ("64746053502", 2629)
    assert (row.checksum, row.checksum_ok) == (7, True)
    assert (row.lat, row.lng, row.altitude, row.speed, row.pos) == (35.695107, 114.239423, 66, 0.0, 305)
    assert (row.time, row.accflag, row.gpsflag) == ("2021-01-13 16:30:05", 1, 1)
    assert (row.gpsdistance, row.mainoilper) == ("6793.20", None)
    assert row.tlv == {1: "0001095c", 3: "0000", 0x25: "00000010", 0x2B: "00006d51", 0x30: "1b", 0x31: "19"}


def test_rejects(spark):
    bad = {FRAME[:-1]: "not_hex", "zz" + FRAME: "not_hex", FRAME[:40]: "short_frame", "": "empty", "0200": "short_header"}
    got = {r.frame: r.reject_reason for r in decoded(spark, [*bad, None, FRAME])[1].collect()}
    assert got == {**bad, None: "empty"}


def test_failfast_stops(spark):
    with pytest.raises(Exception, match="undecodable frame: not_hex"):
        decoded(spark, [FRAME, "xy"], mode="FAILFAST")[0].collect()
    assert decoded(spark, [FRAME], mode="FAILFAST")[0].count() == 1


def xor(body):
    out = 0
    for b in bytes.fromhex(body):
        out ^= b
    return out


def frame(body, props=None, sub=""):
    head = "0200" + f"{len(body) // 2 if props is None else props:04x}" + "a12345678901" + "000a" + sub
    return head + body + f"{xor(head + body):02x}"


FIXED = "0002800000000003" + "0220aa03" + "06cf27bf" + "0042" + "0064" + "0131" + "210113163005"


def test_sub_package_bcd_and_duplicate_items(spark):
    body = FIXED + "0202000a" + "02020014" + "30ff"  # the last item does not fit
    whole = frame(body, props=len(body) // 2 | 0x2000 | 0x0400 | 0x4000, sub="00050003")
    row = decoded(spark, [whole])[0].first()
    assert (row.header.sub_package_total, row.header.sub_package_seq) == (5, 3)
    assert (row.header.encryption, row.header.reserved) == (1, 1)
    assert row.header.terminal_phone == "1012345678901"
    assert row.tlv == {2: "0014"} and row.mainoilper == "2.0" and row.gpsdistance == "0"
    assert (row.speed, row.sharpturn, row.brake) == (10.0, 1, 1)


def test_bad_time_and_long_item(spark):
    body = FIXED[:44] + "2113aa000000" + "0180" + "00" * 128
    row = decoded(spark, [frame(body)])[0].first()
    assert row.time is None and row.tlv == {}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**32 - 1), st.integers(0, 90_000_000), st.integers(0, 180_000_000),
                          st.integers(0, 9999), st.integers(0, 359)), min_size=5, max_size=20))
def test_encode_decode_identity(spark, points):
    texts = [frame(f"{w:08x}{w:08x}{a:08x}{o:08x}0001{s:04x}{d:04x}240229235959") for w, a, o, s, d in points]
    got = [
        (r.alarm_word, round(r.lat * 1e6), round(r.lng * 1e6), round(r.speed * 10), r.pos, r.checksum_ok)
        for r in decoded(spark, texts)[0].select("alarm_word", "lat", "lng", "speed", "pos", "checksum_ok").collect()
    ]
    assert sorted(got) == sorted((*p, True) for p in points)


def test_coordinates(spark):
    gcj = geo.wgs_to_gcj(F.lit(114.239423), F.lit(35.695107))
    bd = geo.gcj_to_bd(*gcj)
    back = geo.bd_to_gcj(*bd)
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate([*gcj, *bd, *back])]).first()
    assert row.c0 == pytest.approx(114.24533900691449, abs=1e-6) and row.c1 == pytest.approx(35.69497733213832, abs=1e-6)
    assert row.c2 == pytest.approx(114.25174104128105, abs=1e-6) and row.c3 == pytest.approx(35.70130831348861, abs=1e-6)
    assert row.c4 == pytest.approx(row.c0, abs=1e-5) and row.c5 == pytest.approx(row.c1, abs=1e-5)


def test_time_ranges(spark):
    cases = [
        ("2020-10-20 08:46:39", "05:00", "23:00:00", True), ("2020-10-20 23:30:00", "22:00", "06:00", True),
        ("2020-10-20 12:00:00", "22:00", "06:00", False), ("2020-10-20 22:00:00", "22:00", "06:00", False),
    ]
    df = spark.createDataFrame(cases, "t string, b string, e string, want boolean")
    sec = timefn.epoch_seconds(timefn.parse_time(F.col("t")))
    assert df.where(timefn.in_time_range(sec, F.col("b"), F.col("e")) != F.col("want")).count() == 0
    minute = timefn.in_effective_date(
        timefn.epoch_seconds(F.lit("2024-01-20 12:00:59").cast("timestamp_ntz")), F.lit("2024-01-10 00:00"), F.lit("2024-01-20 12:00")
    )
    assert spark.range(1).select(minute).first()[0] is True


def test_polygon_and_distance(spark):
    ring = geo.polygon_edges(geo.polygon_from_text(F.lit("0,0;0,4;4,4;4,0;2,2")))
    points = [(1.0, 3.0, True), (2.0, 1.0, False), (3.5, 1.0, True), (5.0, 1.0, False)]
    df = spark.createDataFrame(points, "x double, y double, want boolean")
    assert df.where(geo.in_polygon(F.col("x"), F.col("y"), ring) != F.col("want")).count() == 0
    a = geo.distance_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    b = geo.distance_m(F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(0.0))
    row = spark.range(1).select(a.alias("a"), b.alias("b")).first()
    assert row.a == row.b == pytest.approx(111194.9266, abs=1e-3)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, small):
    """Place joins neither test all pairs nor shuffle positions; scalar work stays in the JVM."""
    from haulwatch.plans.registry import QUERIES

    for name in ("join_site_500m", "join_region", "fence_violations", "inout_pairs", "illegal_disposal", "trips"):
        text = plan(QUERIES[name](spark, small))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
    for name in ("decode_frames", "tracks_bd09", "off_route_points", "data_bus", "inout_dwell", "stop_episodes"):
        text = plan(QUERIES[name](spark, small))
        assert "Python" not in text and "Pandas" not in text and "MapInArrow" not in text, name
    text = plan(QUERIES["today_tracks"](spark, small))
    scan = next(line for line in text.split("\n") if "FileScan" in line)
    assert "value" not in scan.split("ReadSchema")[1]


def test_point_in_time_partition(spark, small):
    from haulwatch.sources.tables import day_partition

    assert day_partition(dt.date(2024, 3, 1), -1) == {"month_id": "2024-02", "day_id": "29"}
    assert view(spark, small, "v_track").count() > 0


def test_sql_functions(spark, small):
    from haulwatch.functions import sql

    sql.register(spark)
    tracks = view(spark, small, "v_track")
    tracks.createOrReplaceTempView("sql_tracks")
    got = spark.sql(
        "SELECT event_id, round(distance_m(lng, lat, 113.6D, 34.7D), 4) AS d,"
        " in_time_range(second_of_day(t_sec), clock_seconds('22:00'), clock_seconds('06:00:00')) AS n FROM sql_tracks"
    )
    d = geo.distance_m(F.col("lng"), F.col("lat"), F.lit(113.6), F.lit(34.7))
    want = tracks.select(
        "event_id", F.round(d, 4).alias("d"),
        timefn.in_time_range(F.col("t_sec"), F.lit("22:00"), F.lit("06:00:00")).alias("n"),
    )
    assert got.exceptAll(want).count() == 0 and got.count() == tracks.count()
