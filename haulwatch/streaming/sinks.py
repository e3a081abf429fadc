"""Sinks, for batch frames and for the frames of a micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.operators.movement import replace_known
from haulwatch.session import remove_path
from haulwatch.sources.messages import to_json
from haulwatch.sources.tables import latest_per_key

PARTITION = ["month_id", "day_id", "hour_id"]


def _gathered(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a partition brought together, so that not every task writes a file into every
    partition. Rebalancing splits a partition that is too large for one task."""
    return df.hint("rebalance", *by)


def append_partitioned(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Adds rows to a partitioned table, once: for batch jobs. Streams use :class:`BatchTable`."""
    by = by or PARTITION
    _gathered(df, by).write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces exactly the partitions that occur in ``df``."""
    _gathered(df, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def overwrite_static(df: DataFrame, path: str, values: dict[str, str]) -> None:
    """Replaces one named partition, also when ``df`` is empty: the files are written straight
    into the partition's folder."""
    folder = "/".join([path.rstrip("/"), *[f"{k}={v}" for k, v in values.items()]])
    df.drop(*values).write.mode("overwrite").parquet(folder)


def write_documents(df: DataFrame, path: str, key: str | None = None, batch_id: int = 0) -> None:
    """JSON documents, one per line; with a key a document occurs once in its batch. A batch owns a folder
    that a replay replaces."""
    docs = df.dropDuplicates([key]) if key else df
    docs.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/batch={batch_id}")


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, key: list[str]):
    """Streaming query that writes rows as keyed JSON messages."""
    return (
        to_json(df, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).option("checkpointLocation", checkpoint)
    )


class BatchTable:
    """Append-only table of micro-batches, partitioned by ``by`` inside a batch. Each batch owns a
    folder that a replay replaces, so a batch that is run twice leaves its rows once; readers prune by the
    partition columns as in any table."""

    def __init__(self, path: str, by: list[str] | None = None):
        self.path, self.by = path, by or []

    def write(self, df: DataFrame, batch_id: int) -> None:
        rows = _gathered(df, self.by) if self.by else df
        rows.write.mode("overwrite").partitionBy(*self.by).parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch")


class StateTable:
    """Current state per key: a snapshot, and a log of the keys that changed since.

    A batch appends its newest row of each key to the log, in a folder of its own that a replay replaces; it neither
    reads nor rewrites the snapshot. Every ``compact_every`` batches, before its own rows, a batch folds the log into the
    next snapshot. What a snapshot is made of stays until the batch after it, which Spark starts only once the former is
    committed, and is removed then; so a replay finds all it needs, and names follow from the batch's number alone.

    Snapshot and log are dealt to ``buckets`` by a hash of the key, so a reader of some keys opens their buckets only.
    Keys that the first snapshot lacks are never added. ``schema`` names the columns of logged rows, with the keys."""

    def __init__(
        self, path: str, keys: list[str], order: list[str], schema: str, buckets: int = 64, compact_every: int = 20
    ):
        self.path, self.keys, self.order, self.schema = path, keys, order, schema
        self.buckets, self.compact_every = buckets, compact_every

    def _snapshot(self, batch_id: int) -> str:
        return f"{self.path}/snapshot/before={batch_id}"

    def _log(self, batch_id: int) -> str:
        return f"{self.path}/log/batch={batch_id}"

    def _since(self, batch_id: int) -> int:
        """The batch before which the snapshot was made that holds for the rows of a batch."""
        return max(batch_id, 0) // self.compact_every * self.compact_every

    def _write(self, df: DataFrame, path: str) -> None:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows = df.withColumn("bucket", bucket)
        _gathered(rows, ["bucket"]).write.mode("overwrite").partitionBy("bucket").parquet(path)

    def create(self, known: DataFrame) -> None:
        self._write(known, self._snapshot(0))

    def update(self, df: DataFrame, batch_id: int) -> None:
        """Logs the newest row of each key of a batch."""
        if batch_id and batch_id % self.compact_every == 0:
            self._write(self.read(df.sparkSession, batch_id - 1), self._snapshot(batch_id))
        self._write(latest_per_key(df, self.keys, self.order), self._log(batch_id))
        if batch_id > 1 and batch_id % self.compact_every == 1 % self.compact_every:
            made = self._since(batch_id - 1)
            for old in range(made - self.compact_every, made):
                remove_path(df.sparkSession, self._log(old))
            remove_path(df.sparkSession, self._snapshot(made - self.compact_every))

    def read(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The state after a batch (-1: the first snapshot). Of a key's rows in snapshot and log the one that comes
        last in the order holds."""
        since = self._since(batch_id)
        known = spark.read.parquet(self._snapshot(since))
        logs = [self._log(b) for b in range(since, batch_id + 1)]
        if not logs:
            return known.drop("bucket")
        fresh = spark.read.schema(f"{self.schema}, batch int, bucket int").option("basePath", f"{self.path}/log")
        fresh = fresh.parquet(*logs).drop("batch")
        fresh = latest_per_key(fresh, [*self.keys, "bucket"], self.order)
        if self.order[0] in known.columns:
            old = known.select(*self.keys, "bucket", F.struct(*self.order).alias("_old"))
            fresh = fresh.join(old, [*self.keys, "bucket"])
            newer: Column = F.col(f"_old.{self.order[0]}").isNull() | (F.struct(*self.order) > F.col("_old"))
            fresh = fresh.where(newer).drop("_old")
        return replace_known(known, fresh, [*self.keys, "bucket"]).drop("bucket")
