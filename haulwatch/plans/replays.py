"""Queries that run the streaming jobs over positions as they arrive: out of order, late, in three deliveries, with a
restart from the checkpoint before each of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.operators.asof import as_of
from haulwatch.plans import streams
from haulwatch.plans.registry import register, rounded
from haulwatch.session import new_shared_path
from haulwatch.sources.derived import view
from haulwatch.streaming import sinks
from haulwatch.streaming.dims import RefreshedDim, per_batch
from haulwatch.streaming.stateful import split_late

ARRIVALS = 3
#: Positions may be this late and still take their place.
ALLOWANCE = "900 seconds"
KEY = streams.KEY

Job = Callable[[DataFrame], DataFrame]


def delivered(spark: SparkSession, folder: str, start: Callable, restarts: int = 1) -> str:
    """Delivers the positions of ``v_arrival`` and runs a stream over them until it has read all, ``restarts`` times for
    each delivery. ``start(stream, path)`` gives the writer; the folder of its results is returned.

    The parts of a state are dealt once, with the first checkpoint, and each costs a few files a micro-batch: the stream
    has a session of its own, with as many parts as the cluster has cores."""
    path = new_shared_path(spark, "arrivals")
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    rows = view(spark, folder, "v_arrival").drop("delay")
    for arrival in range(ARRIVALS):
        rows.where(F.col("arrival") == arrival).drop("arrival").write.parquet(f"{path}/in/{arrival}")
        for _ in range(restarts):
            live = session.readStream.schema(rows.drop("arrival").schema).parquet(f"{path}/in/*")
            writer = start(live, f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
            writer.trigger(availableNow=True).start().awaitTermination()
    return f"{path}/out"


def streamed(spark: SparkSession, folder: str, job: Job, restarts: int = 1) -> DataFrame:
    """What a job has given after all deliveries."""
    schemas = []

    def start(live: DataFrame, out: str):
        results = job(live)
        schemas.append(results.schema)
        return results.writeStream.format("parquet").option("path", out)

    out = delivered(spark, folder, start, restarts)
    return spark.read.schema(schemas[-1]).parquet(out)


def _timely(job: Job):
    return lambda live: job(live, allowance=ALLOWANCE)


@register
def late_rows(spark, folder):
    """The positions that the stops job could not use, with the reason."""
    job = lambda live: streams.stops(live, gap=3600, allowance=ALLOWANCE, report_late=True)
    return split_late(streamed(spark, folder, job), KEY)[1]


@register
def late_stops(spark, folder):
    job = lambda live: streams.stops(live, gap=3600, allowance=ALLOWANCE)
    return rounded(streamed(spark, folder, job))


@register
def late_alarms(spark, folder):
    return rounded(streamed(spark, folder, _timely(streams.gps_incomplete_alarms)))


@register
def late_trips(spark, folder):
    sites = lambda live: view(live.sparkSession, folder, "v_site")
    return streamed(spark, folder, lambda live: streams.trips(live, sites(live), allowance=ALLOWANCE))


@register
def late_dwell(spark, folder):
    sites = lambda live: view(live.sparkSession, folder, "v_site")
    return streamed(spark, folder, lambda live: streams.dwell(live, sites(live), allowance=ALLOWANCE))


@register
def checkpoint_restart(spark, folder):
    """Online time, with two starts for each delivery: the second finds nothing new and adds nothing."""
    out = streamed(spark, folder, _timely(streams.online_time), restarts=2)
    return out.select("event_id", "vehicle_id", "t_sec", "online_time", "online_status")


@register
def dim_refresh(spark, folder):
    """Each position with the version of its vehicle at the position's own time, whenever it arrives."""
    def start(live: DataFrame, out: str):
        table = sinks.BatchTable(out)
        dim = RefreshedDim(lambda: view(live.sparkSession, folder, "v_vehicle_versions"), seconds=0)
        join = lambda batch, versions: as_of(batch, versions, ["vehicle_id"], valid_to="valid_to")
        return live.select("event_id", "vehicle_id", "t_sec").writeStream.foreachBatch(
            per_batch(join, table.write, versions=dim))

    stored = sinks.BatchTable(delivered(spark, folder, start)).read(spark)
    return stored.select("event_id", "vehicle_id", "t_sec", "valid_from", "car_card_number", "enterprise_id")


@register
def vehicle_state_log(spark, folder):
    """The newest position of each known vehicle after all deliveries, from the snapshot and the log of changes."""
    columns = [*KEY, "t_sec", "event_id", "lng", "lat", "speed"]
    rows = view(spark, folder, "v_arrival").where("manage_state = '1' and audit_state = '1' and t_sec is not null")
    rows = rows.select(*columns, "arrival")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("arrival").schema)
    table = sinks.StateTable(new_shared_path(spark, "state"), KEY, ["t_sec", "event_id"], schema, buckets=8, compact_every=2)
    table.create(view(spark, folder, "v_vehicle").select(*KEY, "car_card_number"))
    for batch in (0, 1, 2, 2):  # the last one is replayed
        table.update(rows.where(F.col("arrival") == batch).drop("arrival"), batch)
    return rounded(table.read(spark, 2))
