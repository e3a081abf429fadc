"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Spark compares this limit with the size of a side before it broadcasts it; a side
    # above it is shuffled and, if skewed, split by the adaptive skew join.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "haulwatch", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: str = "8", memory: str = "12g") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    return build_session(
        "haulwatch-local",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
            "spark.driver.memory": memory,
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can write to: the one the cluster names, or on a single machine,
    where none is named, a new temporary one that goes when the program ends."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    made = tempfile.mkdtemp(prefix="haulwatch-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set(CHECKPOINT_KEY, made)
    return made


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands this package to the executors, as ``--py-files`` does, so that functions of its modules can be named
    there whatever folder the workers were started in. Once per application; Spark serves the file itself."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="haulwatch-code-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def new_shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by key in as many parts as a shuffle has, for steps that sort wide rows. Parts that Spark makes of its own
    accord are put together until there is one per core, so that a task's memory would grow with the data."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, however many branches read them."""
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system; nothing if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
