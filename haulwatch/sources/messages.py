"""Message sources: JSON records and raw frames, from Kafka or from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haulwatch.functions import timefn


def read_topic(
    spark: SparkSession, servers: str, topic: str, *, starting: str = "latest",
    max_per_trigger: int | None = None, streaming: bool = True,
) -> DataFrame:
    """Kafka topic as (key, value text, timestamp). ``starting`` is 'latest', 'earliest' or a
    JSON text of offsets per partition. Progress lives in the query's checkpoint."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if streaming or starting != "latest":
        reader = reader.option("startingOffsets", starting)
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(
        F.col("key").cast("string"), F.col("value").cast("string"), "timestamp"
    )


def read_file_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Files arriving in a folder, as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def parse_json(df: DataFrame, schema: StructType, value: str | Column = "value") -> DataFrame:
    """JSON text column to the columns of ``schema``; text that is no JSON gives nulls."""
    column = F.col(value) if isinstance(value, str) else value
    return df.select(F.from_json(column, schema).alias("_r")).select("_r.*")


def parse_bus(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Messages of the data bus as the stateful jobs read them: ``t_sec`` from the text of the time, null
    if that is no time, and ``event_id``, a digest of the message, which a replay gives again."""
    parsed = df.select(F.from_json(value, schema).alias("_r"), F.xxhash64(value).alias("event_id")).select("_r.*", "event_id")
    return parsed.withColumn("t_sec", timefn.epoch_seconds(timefn.parse_time(F.col("time"))))


def to_json(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows as (key, value) messages; null fields are written. The key keeps the messages of
    one vehicle in one partition of the topic."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    if not key:
        return df.select(value)
    return df.select(F.concat_ws("-", *[F.col(k).cast("string") for k in key]).alias("key"), value)
