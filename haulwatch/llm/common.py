"""What the text operators share: reading the tables, words, and tables kept in the shared folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from haulwatch.session import new_shared_path, remove_path, ship

#: A word is a run of characters other than the ASCII blanks (space, tab, LF, VT, FF, CR).
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage, survives executors."""
    return saved_at(df, label)[0]


def saved_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As `saved`, with the folder, for loops that replace a table by the next one."""
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def replaced(df: DataFrame, label: str, old: str | None) -> tuple[DataFrame, str]:
    """As `saved_at`; the folder `old`, which the rows may come from, goes once they are written."""
    out = saved_at(df, label)
    if old is not None:
        remove_path(df.sparkSession, old)
    return out


#: What this Python worker holds beyond a batch, and how to let go of it.
_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, release: Callable[[], None]) -> None:
    """Called by an operator's task before it fills its caches: a worker serves one stage after the other and holds the
    caches of one operator at a time."""
    others = [name for name in _HELD if name != owner]
    for other in others:
        _HELD.pop(other)()
    _HELD[owner] = release
    if others:
        give_back()


def give_back() -> None:
    """Returns the memory that this worker has freed to the system, where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: Rows that a task turns into Python values at once.
SLICE = 512


def in_slices(rows: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow with SLICE rows at a time, whatever the size of Spark's batches, so that a worker holds few of a batch's
    texts as Python values. `run` gives columns in the order of the schema."""
    target = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                out = run(batch.slice(at, SLICE))
                yield pa.RecordBatch.from_arrays(
                    [out.column(i).cast(field.type) for i, field in enumerate(target)], schema=target)
        give_back()

    return rows.mapInArrow(each, schema)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of the driver as a local relation: Spark knows its size, and so when it can be broadcast."""
    frame = spark.createDataFrame([], schema)
    columns = zip(*rows) if rows else [[] for _ in frame.columns]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}
    arrays = [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, frame.dtypes)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=frame.columns))


def body(text: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, also where use refers to it inside a lambda."""
    return F.transform(F.array(value), use)[0]
