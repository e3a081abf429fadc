import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fixtures import rows_of, table
from haulwatch.llm.exact_dedup import exact_duplicates


def expected(rows, keep):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    best = {text: keep([i for i in ids if i is not None], default=None) for text, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), i == best[t or ""], hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=repr)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_groups(spark, keep):
    docs = table(spark, extra=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(exact_duplicates(docs, keep)) == expected(rows, {"min": min, "max": max}[keep])


def test_null_and_repeated_ids(spark):
    rows = [(None, "a"), (1, "a"), (1, "a"), (None, "b"), (2, "c"), (2, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(exact_duplicates(docs, "max")) == expected(rows, max)


def test_colliding_hashes(spark):
    docs = table(spark)
    weak = exact_duplicates(docs, "max", lambda text: F.lit(0))
    assert rows_of(weak) == rows_of(exact_duplicates(docs, "max"))


def test_empty(spark):
    assert exact_duplicates(table(spark, [])).count() == 0
