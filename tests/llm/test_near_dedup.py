import numpy as np
import pandas as pd
import pytest

from fixtures import WORDS, table, texts
from haulwatch.llm import components, near_dedup as N


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    take = min(width, len(words))
    return frozenset(tuple(words[i:i + take]) for i in range(len(words) - take + 1))


def plain(rows, width, pct=80):
    sets = {i: shingle_set(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= pct * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def drifting(seed, n=60):
    """A chain of copies, each a little changed, so that its ends are far apart, and groups around it."""
    rng = np.random.default_rng(seed)
    words = list(rng.choice([f"{a}{b}" for a in WORDS for b in range(40)], 150))
    out = []
    for _ in range(n):
        words = list(words)
        for at in rng.integers(0, len(words), int(rng.integers(0, 9))):
            words[at] = f"new{rng.integers(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_against_all_pairs(spark, width):
    rows = texts() + drifting(1) + drifting(2) + ["WORD", "other word", "Other  WORD"] + ["É a", "é a"]
    docs = table(spark, rows, extra=True)
    got = sorted(map(tuple, N.near_duplicates(docs, width).collect()))
    assert got == plain(list(enumerate(rows)), width)


@pytest.mark.parametrize("block", [1, 7, 512])
def test_members_that_the_hub_does_not_link(spark, monkeypatch, block):
    """Chains of copies whose ends share bands with the hub but no link; the rest is found in blocks."""
    monkeypatch.setattr(N, "BLOCK", block)
    rows = drifting(3, 80) + drifting(3, 80)[::-1] + drifting(8, 50)
    docs = table(spark, rows)
    got = sorted(map(tuple, N.near_duplicates(docs, 2).collect()))
    assert got == plain(list(enumerate(rows)), 2)


def test_block_links(monkeypatch):
    rng = np.random.default_rng(0)
    sets = [np.sort(rng.choice(14, rng.integers(10, 15), replace=False)) for _ in range(60)]
    group = pd.DataFrame({"side": [i % 2 for i in range(60)], "node": range(60), "label": [i % 7 for i in range(60)],
                          "n": [len(x) for x in sets], "shingles": sets})
    want = {(i, j) for i in range(0, 60, 2) for j in range(1, 60, 2) if i % 7 != j % 7
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    for stretch in (3, 4096):
        monkeypatch.setattr(N, "STRETCH", stretch)
        assert set(map(tuple, N._block_links(group, 80).to_numpy().tolist())) == want and want
    assert N._block_links(group[group.side == 0], 80).empty


def test_signature_in_stretches(monkeypatch):
    x = N.shingles(" ".join(str(i) for i in range(5000)), 2)
    whole = N.signature(x)
    monkeypatch.setattr(N, "STRETCH", 17)
    assert (N.signature(x) == whole).all()


def test_repeated_ids_and_nulls(spark):
    text = drifting(4, 1)[0]
    rows = [(7, text), (7, text), (None, text), (3, text + " end"), (None, None), (4, ""), (5, "x"), (5, "y z")]
    out = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert len(out) == len(rows)
    assert {r["component_id"] for r in out if r["n_shingles"] > 100} == {3}
    assert [r["kept"] for r in out if r["n_shingles"] == 0] == [True, True]
    assert N.near_duplicates(table(spark, [])).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 60), (60, 80), (5, 5), (None, 3), (200, 90), (80, 90)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 60 for i in (100, 60, 80, 200, 90)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
