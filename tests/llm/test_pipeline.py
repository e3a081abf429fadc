"""Each stage on what its predecessor kept, against a plain version where there is one."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import compare
from fixtures import table
from haulwatch.llm import packing
from haulwatch.llm.common import documents, labels, saved
from haulwatch.llm.quality_crf import GOOD_FROM, quality_model, scored
from test_line_dedup import plain as plain_lines
from test_near_dedup import plain as plain_near


@pytest.fixture(scope="module")
def steps(spark, medium):
    out = [documents(spark, medium)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], medium), "step"))
    return out


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(steps):
    assert [s.columns for s in steps[:-1]] == [steps[0].columns] * 5


def test_quality(spark, steps, medium):
    kept, marks = texts_of(steps[1]), {r["doc_id"]: r["quality"] for r in labels(spark, medium).collect()}
    good = [i for i, q in marks.items() if q == 1]
    bad = [i for i, q in marks.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.99 * len(good) and sum(i in kept for i in bad) <= 0.05 * len(bad)
    model = quality_model(steps[0], labels(spark, medium))
    assert set(kept) == {r["doc_id"] for r in scored(steps[0], model).where(f"score >= {GOOD_FROM}").collect()}


def test_lines(steps):
    want = plain_lines(sorted(texts_of(steps[1]).items()), 50)
    before = texts_of(steps[1])
    want = {i: t for i, t in want.items() if t == before[i] or re.search(r"[^\x20\x09-\x0D]", t)}
    got = steps[2].collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_near_copies(steps):
    want = {i for i, _, _, kept in plain_near(sorted(texts_of(steps[2]).items()), 5) if kept}
    assert set(texts_of(steps[3])) == want


def test_mix_and_pack(steps):
    before, mix = texts_of(steps[3]), steps[4].collect()
    assert all(before[r["doc_id"]] == r["text"] for r in mix)
    n = sum(len(ids) // 4 + 1 for ids in packing.token_ids([r["text"] for r in mix], packing.vocabulary()))
    assert steps[5].groupBy().sum("length").first()[0] == n


def test_queries(spark, medium):
    con = connect(medium)
    for name in sorted(entry.TEXT_ORACLES):
        assert compare(spark, con, medium, name) is None, name


def test_query_columns(spark, small):
    wanted = {
        "op1_": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op2_": "doc_id piece start length ids_crc32 sequence_id offset", "op4_": "doc_id size source_size target taken",
        "op5_": "doc_id held_out score predicted", "op6_": "doc_id keep_id group_size kept text_sha256",
        "op7_": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op8_": "doc_id n_shingles component_id kept", "op9_": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op11_": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op12_": "doc_id leaf subroot root proof_sha256 folded_root verified", "op13_": "word form root n n_near form_n"}
    for prefix, names in wanted.items():
        (query,) = [q for name, q in entry.TEXT_QUERIES.items() if name.startswith(prefix)]
        assert set(names.split()) <= set(query(spark, small).columns)


@pytest.mark.parametrize("kind", ["plain", "clashing columns", "null ids", "empty"])
def test_awkward_rows(spark, tmp_path, kind):
    """Every stage takes them and keeps the columns of documents as they are; only packing has its own."""
    folder = str(tmp_path)
    docs = table(spark, [] if kind == "empty" else None, extra=kind == "clashing columns")
    if kind == "null ids":
        docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(30)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    extra = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    known = {tuple(r) for r in docs.select("doc_id", *extra).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = saved(stage(spark, now, folder), "step")
        assert now.dtypes == docs.dtypes, name
        assert {tuple(r) for r in now.select("doc_id", *extra).collect()} <= known, name
    n = corpus_pipeline.STAGES[-1][1](spark, now, folder).count()
    assert n > 0 if kind != "empty" else n == 0


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.sql(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con
