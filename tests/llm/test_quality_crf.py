import itertools
import zlib

import numpy as np
import pytest

from fixtures import prose, table, texts
from haulwatch.llm import quality_crf as Q


def chain(seed):
    rng = np.random.default_rng(seed)
    return Q.Chain(rng.normal(size=3 * Q.FEATURES + 1), rng.normal(size=(2, 2)), np.zeros(Q.FEATURES), np.ones(Q.FEATURES))


@pytest.mark.parametrize("seed", range(5))
def test_marginals_by_enumeration(seed):
    rng = np.random.default_rng(seed)
    lines = rng.integers(1, 6, 7)
    model = chain(seed)
    inputs = rng.normal(size=(lines.sum(), 3 * Q.FEATURES + 1))
    good, moves = model.marginals(inputs, lines)
    want, want_moves, at = [], np.zeros((2, 2)), 0
    for n in lines:
        score = inputs[at:at + n] @ model.weights
        paths = list(itertools.product((0, 1), repeat=n))
        weight = np.array([np.exp(score @ np.array(p) + sum(model.moves[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        weight /= weight.sum()
        want += [sum(w for w, p in zip(weight, paths) if p[t]) for t in range(n)]
        for w, p in zip(weight, paths):
            for a, b in zip(p, p[1:]):
                want_moves[a, b] += w
        at += n
    assert good == pytest.approx(want) and moves == pytest.approx(want_moves)


def test_features():
    x, size, lines = Q.line_features(["Ab 12 $$\n\nab ab ab", "", "é"])
    assert lines.tolist() == [3, 1, 1] and size.tolist() == [8, 0, 8, 0, 2]
    assert x[2, 9] == pytest.approx(2 / 3)  # repeated words
    assert x[1, -1] == x[3, -1] == 1 and x[0, -1] == 0
    alone = Q.line_features(["é"])[0]
    assert x[4] == pytest.approx(alone[0])  # other texts do not matter


def test_long_texts_in_stretches(monkeypatch):
    """Stretches of a text give the score of the whole; lines repeat across stretches, lines may be empty."""
    rng = np.random.default_rng(7)
    model = chain(3)
    long = [prose(rng, 70), "\n" * 40, "a b\n" * 30 + prose(rng, 20) + "\n\na b", "x" * 500 + "\n" * 25 + "A 1 $"]
    want = Q.text_odds(model, long)
    for lines in (1, 2, 7, 24):
        monkeypatch.setattr(Q, "PORTION_LINES", lines)
        monkeypatch.setattr(Q.stretches, "__defaults__", (lines,))
        assert ["\n".join(Q.stretches(text)) for text in long] == long
        assert Q.text_odds(model, long) == pytest.approx(want, abs=1e-6)


def test_memory_of_a_text_of_line_feeds():
    import tracemalloc

    model, text = chain(4), "\n" * 300_000
    tracemalloc.start()
    Q.text_odds(model, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6


def labelled(spark, n=600):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        text = prose(rng, int(rng.integers(2, 9)))
        if i % 4 == 0:
            text = text.replace(" ", " | ") if i % 8 else "\n".join(line + "$$$ ###" for line in text.upper().split("\n"))
        rows.append((i, text, int(i % 4 != 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_held_out_accuracy(spark):
    rows = labelled(spark)
    model = Q.quality_model(rows.drop("quality"), rows.select("doc_id", "quality"))
    out = Q.scored(rows, model).withColumn("held_out", Q.held_out()).toPandas()
    assert out.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]
    held = out[out.held_out]
    assert ((held.score >= Q.GOOD_FROM) == (held.quality == 1)).mean() >= 0.97
    # the held-out labels, language and source change nothing
    import pyspark.sql.functions as F
    turned = rows.select("doc_id", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"))
    again = Q.scored(rows, Q.quality_model(rows.drop("quality"), turned)).toPandas()
    assert again.score.tolist() == out.score.tolist()


def test_edges(spark):
    docs = table(spark, extra=True)
    marks = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(40)] + [(5, 0), (5, 1), (None, 1), (6, None)],
                                  "doc_id long, quality int")
    out = Q.scored(docs, Q.quality_model(docs, marks)).collect()
    assert len(out) == len(texts()) and all(0 <= r["score"] <= 1 for r in out)
    assert Q.quality_model(docs, marks.limit(0)) is None
    assert {r["score"] for r in Q.scored(docs, None).collect()} == {0.5}
    assert Q.good_documents(table(spark, []), marks).count() == 0
    assert Q.good_documents(docs, marks).columns == docs.columns


def test_long_documents_do_not_end_the_sample(spark, monkeypatch):
    monkeypatch.setattr(Q, "SAMPLE_LINES", 400)
    rows = [f"text {i}\nsecond line" for i in range(30)] + [f"long {i}" + "\nline" * 500 for i in range(30)]
    docs = table(spark, rows)
    marked = lambda quality: spark.createDataFrame([(i, quality(i)) for i in range(60)], "doc_id long, quality int")
    sample = Q.training_sample(docs, marked(lambda i: i % 2))
    assert len(sample) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(30))
    with pytest.raises(ValueError):
        Q.quality_model(docs, marked(lambda i: int(i < 30)))
