"""Trees and proofs against a plain walk, level by level."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fixtures import table
from haulwatch.llm import merkle
from haulwatch.llm.merkle import FIELDS, folded, leaf, manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(hashes):
    """The root, and of each leaf the (left, right) steps to it."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for i, path in enumerate(paths):
            run = at[i] // 8 * 8
            path.append(("".join(hashes[run:at[i]]), "".join(hashes[at[i] + 1:run + 8])))
        hashes = [h(*hashes[i:i + 8]) for i in range(0, len(hashes), 8)]
        at = [i // 8 for i in at]
    return hashes[0], paths


def first_null(value):
    return (value is not None, value if value is not None else 0)


def plain(rows):
    """(doc_id, lang, leaf, subroot, root, path) of rows (doc_id, lang, leaf)."""
    groups = defaultdict(list)
    for doc_id, lang, own in rows:
        groups[lang].append((doc_id, own))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda x: (first_null(x[0]), x[1]))
        trees[lang] = plain_tree([own for _, own in groups[lang]])
    root, upper = plain_tree([trees[lang][0] for lang in langs])
    return sorted(((doc_id, lang, own, trees[lang][0], root, [*path, *upper[i]])
                   for i, lang in enumerate(langs) for (doc_id, own), path in zip(groups[lang], trees[lang][1])), key=repr)


def leaves(docs):
    return docs.select("doc_id", "lang", leaf([F.col(c) for c in FIELDS]).alias("leaf"))


def check(docs):
    rows = leaves(docs)
    out = manifest(rows, "lang", ["doc_id"], ["doc_id"])
    out = out.withColumn("again", folded(F.col("leaf"), F.col("path")))
    got = out.collect()
    assert all(r["again"] == r["root"] for r in got)
    flat = sorted(((r["doc_id"], r["lang"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]])
                   for r in got), key=repr)
    assert flat == plain([tuple(r) for r in rows.collect()])
    return flat


def test_leaf(spark):
    docs = table(spark, extra=True)
    want = {plain_leaf(tuple(r)) for r in docs.select(*FIELDS).collect()}
    assert {r["leaf"] for r in leaves(docs).collect()} == want


def test_awkward_rows(spark):
    """Nulls in any column, repeated rows, null and repeated ids, columns that clash."""
    docs = table(spark, extra=True)
    none = [F.lit(None).cast(kind).alias(name) for name, kind in docs.dtypes]
    again = docs.where("doc_id < 30")
    lost = docs.where("doc_id < 20").withColumn("doc_id", F.lit(None).cast("long"))
    check(docs.unionByName(again).unionByName(docs.limit(1).select(*none)).unionByName(lost))


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 512, 513, 4_097])
def test_sizes(spark, n):
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"),
        F.col("id").cast("string").alias("text"))
    check(docs)


def test_many_languages_and_a_hot_one(spark):
    """One key has a third of the rows; the others give a tree of several levels over the languages."""
    docs = spark.range(2_400).select(
        (F.col("id") * 7 % 2_400).alias("doc_id"), F.lit("s").alias("source"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("x"), (F.col("id") % 600).cast("string"))).alias("lang"),
        F.lit(None).cast("long").alias("n_chars"), F.lit(None).cast("string").alias("text"))
    flat = check(docs)
    assert len({lang for _, lang, *_ in flat}) == 401


def test_tampering(spark, small):
    rows = merkle.op12_merkle_manifest(spark, small).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    import zlib

    for row in rows:
        hit = zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
        changed = hit and any("A" <= c <= "Z" for c in texts[row["doc_id"]] or "")
        assert row["verified"] == (not changed) and (row["folded_root"] == row["root"]) == (not changed)


def test_empty(spark):
    assert manifest(leaves(table(spark, [])), "lang", ["doc_id"], ["doc_id"]).count() == 0
