"""Words, near words, forms and roots against plain loops."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fixtures import rows_of, table
from haulwatch.llm import spelling
from haulwatch.llm.spelling import near_words, neighbourhood, planted, reduced_keys, roots, runs, variants, word_counts

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(rows, noise):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and code % 97 == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i:] == b[i + 1:] or len(a) == len(b) and a[i + 1:] == b[i + 1:]


def plain(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v), default=None) for w in words}
    form = {w: best[w] if best[w] is not None and words[best[w]] >= 2 * words[w] else None for w in words}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None)
                   for w, n in words.items()), key=repr)


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def made_up(seed, n, letters, lengths=(5, 9)):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*lengths))) for _ in range(n)}
    return {w: rng.randint(3, 300) for w in sorted(words)}


def test_runs():
    texts = ["Ab-çÀ×÷ÿ漢Éb́x", "ĀaƁb\xaaç\xb5", "", "\n", "a\xc2b", "ÃÃ Ã"]
    for text in texts + [chr(i) + "a" + chr(i) for i in [*range(0x300), 0x2019, 0xFB01, 0x1F600]]:
        assert [run.decode() for run in runs(text)] == [run.translate(LOWER) for run in RUN.findall(text)], text


@pytest.mark.parametrize("noise", [None, planted])
def test_word_counts(spark, noise):
    docs = table(spark, extra=True).unionByName(table(spark, ["harbor " * 500, None], extra=True).selectExpr(
        "cast(null as long) as doc_id", *[f"{c}" for c in table(spark, [], extra=True).columns[1:]]))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["word"]: r["n"] for r in word_counts(docs, noise).collect()}
    assert got == plain_words(rows, noise is not None)


def test_counts_handed_over(spark, monkeypatch):
    """What a task hands over early adds up."""
    docs = table(spark)
    want = rows_of(word_counts(docs, planted))
    monkeypatch.setattr(spelling, "COUNTED", 5)
    assert rows_of(word_counts(docs, planted)) == want


def test_neighbourhood():
    """All words of the reduced alphabet at one edit, each once."""
    alphabet, rng = (1, 2, 3), random.Random(3)
    for length in range(1, 7):
        word = [rng.choice(alphabet) for _ in range(length)]
        want = {tuple(word)}
        for i in range(length + 1):
            want |= {(*word[:i], c, *word[i:]) for c in alphabet}
            if i < length:
                want |= {(*word[:i], *word[i + 1:])} | {(*word[:i], c, *word[i + 1:]) for c in alphabet}

        def number(x):
            return sum(c * pow(int(spelling._BASE), len(x) - 1 - i, 2**64) for i, c in enumerate(x)) % 2**64

        found = [int(v) for _, some in neighbourhood(np.asarray([word], np.uint64), np.asarray(alphabet, np.uint64)) for v in some]
        assert len(found) == len(set(found)) and set(found) == {number(x) for x in want}


def test_neighbourhood_in_parts(monkeypatch):
    symbols = np.random.default_rng(4).integers(1, 9, (3, 50)).astype(np.uint64)
    alphabet = np.arange(1, 9, dtype=np.uint64)

    def all_of():
        return sorted((int(r), int(v)) for row, near in neighbourhood(symbols, alphabet) for r, v in zip(row, near))

    want = all_of()
    monkeypatch.setattr(spelling, "CELLS", 40)
    assert all_of() == want


def test_keys_agree():
    import pandas as pd

    words = pd.Series(["harbor", "çà", "x" * 5_000, "a", "harbour"])
    alphabet = np.arange(1, 9, dtype=np.uint64)
    for word, key in zip(words, reduced_keys(words, 8)):
        whole = next(neighbourhood(spelling._symbols([word], 8), alphabet))[1]
        assert whole.view(np.int64)[0] == key


@pytest.mark.parametrize("letters", ["abcdefghij", "aiqy", "aeéèê"])
def test_variants(spark, letters):
    words = made_up(5, 400, letters)
    assert rows_of(variants(frame(spark, words))) == plain(words)


def test_large_classes(spark):
    """Words that share all symbols of the first alphabet go on to larger ones, and no pair is lost."""
    words = made_up(6, 500, "aiqyáéñù", (5, 6))
    want = sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))
    for pairs in (1, 50, 10**9):
        assert rows_of(near_words(frame(spark, words), pairs=pairs)) == want


def test_long_words(spark):
    words = {"x" * 20_000: 9, "x" * 19_999: 4, "x" * 10_000 + "y" + "x" * 9_999: 30, "short": 3}
    assert rows_of(variants(frame(spark, words))) == plain(words)


def test_long_way_of_forms(spark):
    chain = {"a" * (5 + i): 3 * 2**i for i in range(20)}
    assert rows_of(variants(frame(spark, chain))) == plain(chain)
    ways = spark.createDataFrame([(w, "a" * (len(w) + 1)) for w in chain], "word string, form string")
    assert {r["root"] for r in roots(ways).collect()} == {"a" * 25}


def test_ties(spark):
    words = {"stone": 3, "stone" + "s": 6, "stony": 6, "atone": 6, "store": 5}
    (row,) = [r for r in variants(frame(spark, words)).collect() if r["word"] == "stone"]
    assert (row["form"], row["n_near"]) == ("atone", 4)


def test_empty(spark):
    assert variants(word_counts(table(spark, []), planted)).count() == 0
    assert variants(word_counts(table(spark, [None, "", "two words"]), planted)).count() == 0
