"""Exact duplicates: grouping by a 128-bit content hash, with the bytes compared inside a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.llm.common import body, documents, saved


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text))


def exact_duplicates(docs: DataFrame, keep: str = "min",
                     digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by the hash and, inside a hash, by the text itself, so that texts whose hashes
    collide never meet; both keys are combined on the map side, which makes a group with a third of all
    rows as cheap as any other. Rows then find their group by hash and SHA-256; a group of these two
    that held different bytes would end the job rather than give a wrong answer.

    keep="min" keeps the smallest doc_id of equal texts, "max" the largest. A null text equals the empty
    one. A null doc_id stays only if no row of its group has an id. Rows that repeat both doc_id and text
    are one document and share its decision; all of them count in group_size. Other columns are ignored."""
    if keep not in ("min", "max"):
        raise ValueError("keep must be min or max")
    pick = F.min if keep == "min" else F.max
    rows = docs.select("doc_id", body().alias("body")).select(
        "doc_id", "body", digest(F.col("body")).alias("h"), F.unhex(F.sha2("body", 256)).alias("s"))
    groups = rows.groupBy("h", "s", "body").agg(
        pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    keyed = groups.groupBy("h", "s").agg(
        F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"),
        F.count(F.lit(1)).alias("texts"))
    # a table of its own: Spark can then split the rows of a hot group between tasks of the join
    members = rows.drop("body").join(saved(keyed, "groups"), ["h", "s"])
    clash = F.raise_error(F.lit("different texts share both digests"))
    return members.select(
        "doc_id", "keep_id", F.when(F.col("texts") > 1, clash.cast("long")).otherwise(F.col("group_size"))
        .alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("s")).alias("text_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir), keep="max")


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
