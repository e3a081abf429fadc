import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import prose, table, texts
from haulwatch.llm import quality_rules as Q
import numpy as np


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts(spark):
    rows = texts() + ["a b c a b c a b c a b", "a a a a", "# * | $%\n# * | $%\n\n"]
    out = Q.text_counts(table(spark, rows)).select("doc_id", *Q.COUNTS).collect()
    assert {r[0]: tuple(r)[1:] for r in out} == {i: plain(t) for i, t in enumerate(rows)}


@pytest.mark.parametrize("n, k", [(1, 0), (50, 0), (500, 3), (4000, 25), (4000, 0), (90_000, 700)])
def test_tail(spark, n, k):
    got = spark.range(1).select(Q.log_binomial_tail(F.lit(n), F.lit(k), 0.01)).first()[0]
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(.01) + (n - i) * math.log(.99)
             for i in range(k + 1)]
    top = max(terms)
    assert got == pytest.approx(top + math.log(sum(math.exp(t - top) for t in terms)), rel=1e-6)


def labelled(spark, n=1500):
    """Good prose and bad documents full of symbols; a third language has hardly any labels."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(texts()[12].split(), 70)) if i % 5 else " ".join(rng.choice(["a$$$", "b###", "c%%%"], 70))
        text = " ".join(f"{w}{j}" for j, w in enumerate(text.split()))
        rows.append((i, text, "en" if i % 100 else "xx", int(i % 5 != 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")


def test_cutoffs_hold_the_risk(spark):
    docs = labelled(spark)
    out = Q.judged(docs.drop("quality"), docs.select("doc_id", "quality")).join(docs.select("doc_id", "lang", "quality"), "doc_id")
    rows = out.where("NOT base_failed").toPandas()
    good, bad = rows[(rows.quality == 1) & (rows.lang == "en")], rows[(rows.quality == 0) & (rows.lang == "en")]
    assert len(good) > 1000 and (~good.kept).mean() <= Q.RISK
    assert not bad.kept.any() and set(bad.failed_rules) >= {"symbols_per_word"}
    # too few labels: only the base rules
    assert rows[rows.lang == "xx"].kept.all()


def plain_steps(rows):
    """stratum -> step of (stratum, good, first step), by exact sums of binomial terms."""
    strata = {x[0] for x in rows if x[1]}
    out = {}
    for name in strata:
        good, bad = ([s for n, g, s in rows if n == name and g == want] for want in (True, False))
        best = None
        for i in range(Q.STEPS):
            k, b, n = sum(s <= i for s in good), sum(s <= i for s in bad), len(good)
            tail = sum(math.comb(n, x) * Q.RISK**x * (1 - Q.RISK) ** (n - x) for x in range(k + 1))
            if tail > Q.ERROR / len(strata):
                break
            gain = b / len(bad) - k / n if bad else 0
            if b and gain > 0 and (best is None or gain > best[0]):
                best = (gain, i)
        if best is not None:
            out[name] = best[1]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_choice_of_steps(spark, seed):
    """Steps against exact sums: strata with many, few and no labels, good documents that strict steps reject."""
    rng = np.random.default_rng(seed)
    rows = []
    for name, n in (("a", 700), ("b", 120), ("c", 80), ("d", 3), ("e", 300)):
        for _ in range(n):
            good = bool(rng.random() < 0.8)
            symbols = int(rng.choice([0, 0, 0, 4, 8, 30])) if good and name == "e" else (
                0 if good and rng.random() < 0.99 else int(rng.choice([1, 8, 40, 180])))
            rows.append((len(rows), name, symbols, good))
    counts = spark.createDataFrame(rows, "doc_id long, stratum string, n_symbols long, good boolean").selectExpr(
        "doc_id", "stratum", "n_symbols", "good", *[f"cast({v} as bigint) as {c}" for c, v in {
            "n_words": 100, "word_chars": 400, "n_dup_lines": 0, "n_repeat_words": 0, "n_lines": 9, "n_marks": 0, "n_capitals": 0}.items()])
    marks = counts.selectExpr("doc_id", "cast(good as int) as quality")
    got = {r["stratum"]: r["step"] for r in Q.safe_steps(counts.drop("good"), marks).collect()}
    cuts = Q.RULES["symbols_per_word"][2]
    first = lambda n: next((i for i, c in enumerate(cuts) if n / 100 > c), Q.STEPS)
    assert got == plain_steps([(name, good, first(n)) for _, name, n, good in rows]) and "a" in got and "d" not in got


def test_false_rejection_on_held_back_documents(spark):
    """Steps learned from half of the labels reject no more than the risk of the other half's good documents."""
    folder = "/root/testdata/sf0.1"
    docs, marks = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    out = Q.judged(docs, marks.where(half)).join(marks.where(~half), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = out.where("NOT base_failed").toPandas()
    assert set(rows["lang"]) == {"de", "en", "es", "fr"}
    for lang, part in rows.groupby("lang"):
        good, bad = part[part.quality == 1], part[part.quality == 0]
        assert (~good.kept).mean() <= Q.RISK and (~bad.kept).mean() > 0.9, lang


def test_edges(spark):
    docs = table(spark, extra=True)
    marks = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (1, None), (99_999, 0)], "doc_id long, quality int")
    out = Q.judged(docs, marks).collect()
    assert len(out) == docs.count()
    assert all(r["kept"] == (not r["base_failed"]) for r in out)
    assert all(r["base_failed"] for r in out if r["n_words"] < 50)
    assert Q.judged(table(spark, []), marks).count() == 0
    assert Q.judged(docs, marks.limit(0)).count() == docs.count()
