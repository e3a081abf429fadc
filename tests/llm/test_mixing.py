import re
from fractions import Fraction

import numpy as np
import pytest

from fixtures import prose, rows_of, table, texts
from haulwatch.llm import mixing as M


def sources(*sizes):
    return [M.Source(0, name, size, 10) for name, size in sizes]


def test_targets():
    got = M.with_targets(sources(("b", 100), ("a", 100), (None, 100), ("c", 100)))
    assert [s.name for s in got] == ["a", "b", "c", None]
    assert [s.target for s in got] == [Fraction(400, 7) * w for w in (1, 2, 3, 1)]
    got = M.with_targets(sources(("a", 900), ("b", 50), ("c", 50)))
    assert [s.target for s in got] == [700, 150, 150]
    assert [s.target for s in M.with_targets(sources(("a", 0), ("b", 5)))] == [0, 5]
    assert M.with_targets([]) == []


def test_tree_deals_every_block_once():
    quotas, shards = [1000, 3, 0, 457], 13
    tree = M.SplittingTree(quotas, shards, 1)
    source = np.repeat(np.arange(4), quotas)
    index = np.concatenate([np.arange(q) for q in quotas])
    shard = tree.shard_of(source, index)
    assert np.bincount(shard, minlength=shards).tolist() == [tree._share(i, i + 1) for i in range(shards)]
    for s in range(4):  # consecutive blocks
        assert (np.diff(shard[source == s]) >= 0).all()
    pick = np.random.default_rng(0).permutation(len(source))[:200]
    assert (tree.shard_of(source[pick], index[pick]) == shard[pick]).all()


def test_fitting():
    sizes = np.array([7, 5, 3, 2, 0])
    assert sizes[M.fitting(sizes, 10, 1)].sum() == 10
    assert not M.fitting(sizes, 1, 1).any()


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(2)
    rows = [prose(rng, int(rng.integers(1, 8))) for _ in range(2500)] + texts()
    return rows, table(spark, rows, extra=True)


def test_taken(spark, many):
    rows, docs = many
    out = M.taken_words(docs).toPandas().sort_values("doc_id")
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in rows]
    assert out["size"].tolist() == size
    assert (out.taken <= 3 * out["size"]).all() and (out.taken % out["size"].clip(lower=1) == 0).all()
    out["source"] = [("a", "b", "c", "~")[i % 4] for i in out.doc_id]
    for _, own in out.groupby("source"):
        assert own["size"].sum() == own.source_size.iloc[0]
        assert abs(own.taken.sum() - own.target.iloc[0]) <= 10
    assert out.target.groupby(out.source).first().sum() == pytest.approx(sum(size))
    assert rows_of(M.taken_words(docs)) == sorted(map(tuple, out.drop(columns="source").itertuples(index=False)), key=repr)


def test_documents_of_the_mix(spark, many):
    _, docs = many
    mix = M.mixed_documents(docs)
    assert mix.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] for r in M.taken_words(docs).collect()}
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in mix.collect()) == sum(taken.values())


def test_edges(spark):
    assert M.taken_words(table(spark, [])).count() == 0
    assert [r["taken"] for r in M.taken_words(table(spark, [None, "", None])).collect()] == [0, 0, 0]
    docs = spark.createDataFrame([(1, "a b c", None)] * 4 + [(None, "d e", None)], "doc_id long, text string, source string")
    out = M.taken_words(docs).toPandas()
    assert len(out) == 5 and out.taken.sum() == 14 and out.target.eq(14).all()
