"""What the text operators share: slices of batches, caches of a worker, tables that replace each other."""

import os

import pyarrow as pa
from pyspark.sql import functions as F

from haulwatch.llm import common


def test_slices(spark):
    """More rows than a slice, of several batches and tasks, with null and large ids; empty tables."""
    rows = spark.range(0, 3_000, 1, 3).select(
        F.when(F.col("id") % 7 > 0, F.col("id") + 2**60).alias("doc_id"), F.col("id").cast("string").alias("body"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        assert 0 < batch.num_rows <= common.SLICE
        sizes = pa.array([len(x) for x in batch.column("body").to_pylist()], pa.int32())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes], names=["doc_id", "n"])

    got = common.in_slices(rows, run, "doc_id long, n long")
    assert got.dtypes == [("doc_id", "bigint"), ("n", "bigint")]
    want = rows.select("doc_id", F.length("body").cast("long").alias("n"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert common.in_slices(rows.limit(0), run, "doc_id long, n long").count() == 0


def test_one_owner_at_a_time(monkeypatch):
    monkeypatch.setattr(common, "_HELD", {})
    one, two = {1: 1}, {2: 2}
    common.hold("one", one.clear)
    common.hold("one", one.clear)
    assert one
    common.hold("two", two.clear)
    assert not one and two
    common.hold("one", one.clear)
    assert not two


def test_replaced(spark):
    first, path = common.saved_at(spark.range(5).toDF("x"), "t")
    second, other = common.replaced(first.where("x > 1"), "t", path)
    assert sorted(r.x for r in second.collect()) == [2, 3, 4]
    local = [p.removeprefix("file:") for p in (path, other)]
    assert [os.path.exists(p) for p in local] == [False, True]
