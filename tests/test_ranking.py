"""Ranks and roll-ups: skewed scores, nulls, and what their plans look like."""

import random

import pytest
from pyspark.sql import functions as F

from haulwatch.operators import violations
from haulwatch.operators.ranking import with_place
from haulwatch.plans import QUERIES
from haulwatch.sources.derived import view


def plain(rows):
    def after(score):
        return (score is None, 0 if score is None else -score)

    return sorted(((i, k, s, 1 + sum(k2 == k and after(s2) < after(s) for _, k2, s2 in rows)) for i, k, s in rows), key=repr)


@pytest.mark.parametrize("kind", ["narrow", "ties", "negative", "nulls"])
def test_place(spark, kind):
    """99 of 100 scores in one hundredth of the range, a tie of most rows, nothing above zero, hardly any score."""
    rng = random.Random(kind)
    score = {
        "narrow": lambda: rng.randint(0, 50) if rng.random() < 0.99 else rng.randint(0, 5_000),
        "ties": lambda: 7 if rng.random() < 0.9 else rng.randint(0, 9), "negative": lambda: -rng.randint(0, 100),
        "nulls": lambda: None if rng.random() < 0.7 else rng.randint(-3, 3)}[kind]
    rows = [(i, rng.choice([1, 1, 1, 2, None]), score()) for i in range(600)]
    got = with_place(spark.createDataFrame(rows, "i int, k int, s int"), ["k"], "s")
    assert sorted((tuple(r) for r in got.select("i", "k", "s", "place").collect()), key=repr) == plain(rows)


def test_null_sum_is_last(spark):
    rows = [(1, "a", 5.0), (2, "b", None), (3, "c", -1.0)]
    detail = spark.createDataFrame(
        [(i, n, s, 1, "p", "c", "a", i) for i, n, s in rows], "transport_enterprise_id int, enterprise_name string, "
        "enterprise_final_score double, dept_id int, province_id string, city_id string, area_id string, vehicle_id int")
    got = {r["enterprise_name"]: r["place"] for r in violations.ranked_enterprises(detail).collect()}
    assert got == {"a": 1, "c": 2, "b": 3}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_frames_are_built_once(spark, small):
    """What a frame is computed from stands in the plan once, whatever is read from the frame."""
    for name in ("decode_frames", "decode_rejects", "frame_header", "frame_state_bits"):
        plan = plan_of(QUERIES[name](spark, small))
        assert plan.count("0x") == 0 and plan.count("concat(0200") == 1, name


def test_empty(spark):
    rows = spark.createDataFrame([], "i int, k int, s int").withColumn("x", F.lit(1))
    assert with_place(rows, ["k"], "s").count() == 0
