import zlib

import numpy as np
import pytest

from fixtures import table, texts
from haulwatch.llm import packing as P


def plain_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        open_ = [i for i, left in enumerate(bins) if left >= n]
        if open_:
            bins[min(open_, key=lambda i: bins[i])] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(25))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(1, 60))
    lengths = rng.integers(1, capacity + 1, rng.integers(0, 300))
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    plan, bins = P.best_fit_plan(counts, capacity)
    left, taken = {}, {n: 0 for n in counts}
    edges = {n: sorted(r for length, r, *_ in plan.tolist() if length == n) + [counts[n]] for n in counts}
    for length, rank, first, each, offset in plan.tolist():
        for at in range(edges[length][edges[length].index(rank) + 1] - rank):
            where, place = first + at // each, offset + at % each * length
            assert capacity - left.get(where, capacity) == place
            left[where] = left.get(where, capacity) - length
            taken[length] += 1
    assert taken == counts and bins == len(left)
    assert sorted(left.values()) == plain_best_fit(lengths.tolist(), capacity)


def test_tree():
    tree = P.Capacities(10)
    for left in (3, 7, 10):
        tree.add(left, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 8, 10)] == [3, 3, 7, 10, 10]
    tree.add(10, -1)
    assert tree.tightest(8) is None


def test_ids_are_those_of_the_whole_text():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.vocabulary())
    more = [" lead", "trail ", "a  b", "a \n b", "x  y", "it's we'll 's", "a <|endoftext|> b", "tab\t c", "1 2 3\n\n4", "  a b"]
    rows = [t for t in texts() if t is not None] + more
    for text, got in zip(rows, P.token_ids(rows, P.vocabulary()), strict=True):
        want = np.asarray(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert got == want, text[:50]


def test_forgetting_changes_nothing(monkeypatch):
    rows = [t for t in texts() if t]
    want = list(P.token_ids(rows, P.vocabulary()))
    monkeypatch.setattr(P, "REMEMBERED", 5)
    monkeypatch.setattr(P, "TOGETHER", 3)
    monkeypatch.setattr(P, "_TOKENIZERS", {})
    assert list(P.token_ids(rows, P.vocabulary())) == want


def test_cut():
    assert P.cut(1, 4) == [(0, 1)] and P.cut(4, 4) == [(0, 4)] and P.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_places(spark, capacity):
    rows = texts()
    docs = table(spark, rows, extra=True)
    docs = docs.unionByName(docs.limit(5))
    out = P.packed(docs, P.vocabulary(), capacity).toPandas()
    ids = {i: one + b"\0\0\0\0" for i, one in enumerate(P.token_ids([t or "" for t in rows], P.vocabulary()))}
    assert all(out.ids_crc32 == [zlib.crc32(ids[i][4 * s:4 * (s + n)]) for i, s, n in zip(out.doc_id, out.start, out.length)])
    assert out.length.sum() == sum(len(ids[r["doc_id"]]) // 4 for r in docs.collect())
    assert all(n == capacity for n, piece in zip(out.length, out.piece) if piece)
    out = out.sort_values(["sequence_id", "offset"])
    ends = (out.offset + out.length).groupby(out.sequence_id).shift(fill_value=0)
    assert (out.offset == ends).all() and (out.offset + out.length).max() <= capacity
    assert out.sequence_id.nunique() == len(plain_best_fit(out.length.tolist(), capacity))


def test_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    assert P.packed(docs, P.vocabulary()).select("sequence_id", "offset").distinct().count() == 3
    assert P.packed(table(spark, []), P.vocabulary()).count() == 0
