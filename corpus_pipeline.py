"""The corpus pipeline: documents of good quality, without repeated line runs and near copies, mixed to target
weights and packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.llm import line_dedup, mixing, near_dedup, packing, quality_crf
from haulwatch.llm.common import documents, labels, replaced
from haulwatch.session import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-chain classifier does not reject; it learns from the labels of these documents."""
    return quality_crf.good_documents(docs, labels(spark, sf_dir))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs. A document that loses every word so is a copy and
    goes; one that had no words before stays. n_chars, where there is one, follows the text."""
    own = {c: f"_own_{c}" for c in ("n_lines", "n_removed", "runs") if c in docs.columns}
    rows = line_dedup.without_repeats(docs.withColumnsRenamed(own))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = rows.where((F.col("n_removed") == 0) | has_words)
    length = F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    return rows.select(*[
        F.when(F.col("n_removed") == 0, F.col(c)).otherwise(length).alias(c) if c == "n_chars" else
        F.col(own.get(c, c)).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id."""
    kept = near_dedup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shard by shard."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return packing.packed(docs, packing.vocabulary())


def _shipped(stage):
    """The stage, for sessions whose executors may not have the package yet."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality classifier", _shipped(quality)),
    ("line dedup", _shipped(lines)),
    ("near copies", _shipped(near_copies)),
    ("mixing", _shipped(mix)),
    ("packing", _shipped(pack)),
]
#: No SQL: the classifier is trained, the mix drawn, and the tokenizer's ids come from a vocabulary file.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; what a stage has read goes then."""
    docs, path = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs, path = replaced(stage(spark, docs, sf_dir), name.replace(" ", "-"), path)
    return docs
