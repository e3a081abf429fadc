import re
from collections import defaultdict

import numpy as np
import pytest

from fixtures import prose, table, texts
from haulwatch.llm import line_dedup


def plain(rows, least):
    """Every run of lines of at least `least` words that also begins earlier loses its lines."""
    lines = {i: [x for x in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x[1])] for i, t in rows}
    places, gone = defaultdict(list), defaultdict(set)
    for i, own in lines.items():
        count = [len(re.findall(r"[^\x20\x09-\x0D]+", line)) for _, line in own]
        for a in range(len(own)):
            for z in range(a, len(own)):
                if sum(count[a:z + 1]) >= least:
                    places[tuple(line for _, line in own[a:z + 1])].append((i, a, z))
                    if sum(count[a + 1:z + 1]) >= least and sum(count[a:z]) >= least:
                        break
    for found in places.values():
        for i, a, z in sorted(found)[1:]:
            gone[i] |= set(range(lines[i][a][0], lines[i][z][0] + 1))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) if gone[i] else t for i, t in rows}


@pytest.mark.parametrize("least", [1, 7, 20, 50])
def test_against_all_runs(spark, least):
    rng = np.random.default_rng(least)
    rows = texts(least)[:-3]
    pool = [prose(rng, 1) for _ in range(6)]
    rows += ["\n".join(rng.choice(pool, 25)) for _ in range(6)]
    docs = table(spark, rows, extra=True)
    out = line_dedup.without_repeats(docs, least)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == plain(list(enumerate(rows)), least)


def test_long_copy_and_repeated_rows(spark):
    rng = np.random.default_rng(5)
    long = prose(rng, 700)
    rows = [(0, long), (1, "First.\n" + long), (1, "First.\n" + long), (None, long), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.without_repeats(docs)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(
        [(0, long), (1, "First."), (1, "First."), (None, long), (2, None)], key=repr)


def test_empty(spark):
    assert line_dedup.without_repeats(table(spark, [])).count() == 0
    assert line_dedup.without_repeats(table(spark, [None, ""])).count() == 2
