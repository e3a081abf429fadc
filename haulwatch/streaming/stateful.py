"""Machines over streams, in event time.

Positions wait in the state until the watermark, which stays ``allowance`` behind the newest position of the stream, has
passed them; then they go through the machine of their vehicle in the order of (time, event id). A position that comes
while the watermark is still before it takes its place, however the stream was cut into micro-batches; a later one changes
nothing and can be reported. Timers of the watermark release what waits and drop a vehicle that has nothing more to say,
so neither depends on the clock, and a replay gives the same rows.

Vehicles are dealt to buckets by a hash of their key, and a state holds the vehicles of a bucket: what a call costs is paid
per bucket and micro-batch, not per vehicle. A task holds what the vehicles of a bucket sent in the allowance and in one
micro-batch; set ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger`` at the source, or ``buckets``, accordingly.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Of a bucket: per vehicle the last position processed and the machine's state as JSON, and the positions that wait. Both
#: are Arrow streams.
STATE = "vehicles binary, waiting binary"
#: Fixed with the first checkpoint of a stream.
BUCKETS = 1024
#: How far positions may come out of order.
ALLOWANCE = "10 minutes"
#: Columns of a position that went into no machine: why, its time and id.
LATE = ("late_reason", "late_t_sec", "late_event_id")
LATE_REASON, REPEATED_REASON, UNTIMED_REASON = "late", "repeated", "untimed"
#: A time that no watermark reaches.
NEVER = "2200-01-01 00:00:00"


def _stored(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _loaded(stored: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(stored)).read_all()


def _advance(machine, keys: list[str], columns: list[str], names: list[str], report_late: bool):
    blank = (None,) * len(StructType.fromDDL(machine.output))
    tail = (None,) * len(LATE) if report_late else ()
    n, order = len(keys), [*keys, "t_sec", "event_id"]

    def run(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs()
        known, parts, out = {}, [], []  # vehicle -> last position, state of its machine
        if state.exists:
            vehicles, waiting = state.get
            if vehicles:
                for *vehicle, t, event_id, body in zip(*_loaded(vehicles).to_pydict().values()):
                    known[tuple(vehicle)] = (t, event_id), json.loads(body)
            if waiting:
                parts.append(_loaded(waiting).to_pandas())
        for frame in frames:
            frame = frame[columns]
            behind = frame["t_sec"] * 1000 <= passed
            if report_late and behind.any():
                for *vehicle, t, event_id in frame.loc[behind, order].itertuples(index=False):
                    out.append((*vehicle, *blank, LATE_REASON, int(t), int(event_id)))
            if not behind.all():
                parts.append(frame[~behind])
        rows = pd.concat(parts, ignore_index=True) if parts else None
        waits = set()
        if rows is not None:
            due = rows["t_sec"] * 1000 <= passed
            for row in rows[due].sort_values(order, kind="stable").itertuples(index=False):
                vehicle, at = tuple(row[:n]), (int(row.t_sec), int(row.event_id))
                last, body = known.get(vehicle) or (None, {})
                if last is not None and at <= last:
                    out += [(*vehicle, *blank, REPEATED_REASON, *at)] if report_late else []
                    continue
                out += [(*vehicle, *emitted, *tail) for emitted in machine.step(body, row)]
                known[vehicle] = at, body
            rows = rows[~due]
            waits = set(rows[keys].itertuples(index=False, name=None))
        # a timer runs off once the watermark is past it: a millisecond before the time that is waited for
        wakes = [int(rows["t_sec"].min()) * 1000 - 1] if waits else []
        kept = []
        for vehicle, (last, body) in known.items():
            if vehicle not in waits:
                idle = machine.idle(body)
                if idle is not None:
                    wake = (last[0] + idle) * 1000 - 1
                    if wake < passed:
                        continue
                    wakes.append(wake)
            kept.append((*vehicle, *last, json.dumps(body)))
        if not kept and not waits:
            if state.exists:
                state.remove()
        else:
            vehicles = _stored(pa.table(dict(zip([*order, "_body"], map(list, zip(*kept)))))) if kept else None
            state.update((vehicles, _stored(pa.Table.from_pandas(rows, preserve_index=False)) if waits else None))
            if wakes:
                state.setTimeoutTimestamp(max(min(wakes), passed))
        if out:
            # as objects: a null beside a whole number must not make a float of it
            yield pd.DataFrame(out, columns=names, dtype=object)

    return run


def run_machine(
    df: DataFrame, machine, keys: list[str], allowance: str = ALLOWANCE, report_late: bool = False, buckets: int = BUCKETS
) -> DataFrame:
    """Rows the machine emits for a stream of positions with ``t_sec`` and ``event_id``, each of these once.

    A position is processed when the newest one of the stream is ``allowance`` ahead of it; one that comes after that
    is late. The state of a vehicle goes when the watermark has passed the time after which, as ``machine.idle`` says, it
    makes no difference.

    With ``report_late`` every position that went into no machine gives a row too, with the columns of :data:`LATE` and
    none of the machine's: late and repeated ones, and those without a key or a time. :func:`split_late` parts both
    in a micro-batch."""
    emitted = StructType.fromDDL(machine.output)
    fields = [StructField(k, df.schema[k].dataType) for k in keys] + emitted.fields
    reasons = [StructField(c, StringType() if c == LATE[0] else LongType()) for c in LATE if report_late]
    result = StructType(fields + reasons)
    rows = df.select(*keys, "t_sec", "event_id", *[c for c in machine.columns if c not in ("t_sec", "event_id")])
    placed = [*keys, "t_sec", "event_id"]
    timed = rows.dropna(subset=placed).withColumn("_at", F.timestamp_seconds("t_sec")).withWatermark("_at", allowance)
    # Spark leaves out rows behind the watermark before a function sees them. They are to be reported, so the mark of
    # the event time goes to a column that is never behind; the watermark itself follows _at.
    mark = timed.schema["_at"].metadata
    timed = timed.withColumn("_never", F.lit(NEVER).cast("timestamp")).drop("_at").withMetadata("_never", mark)
    timed = timed.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    out = timed.groupBy("_bucket").applyInPandasWithState(
        _advance(machine, keys, rows.columns, result.names, report_late), result, STATE, "append",
        GroupStateTimeout.EventTimeTimeout)
    if not report_late:
        return out
    missing = F.lit(False)
    for column in placed:
        missing = missing | F.col(column).isNull()
    untimed = rows.where(missing).select(
        *keys, *[F.lit(None).cast(f.dataType).alias(f.name) for f in emitted.fields],
        F.lit(UNTIMED_REASON).alias(LATE[0]), F.col("t_sec").alias(LATE[1]), F.col("event_id").alias(LATE[2]))
    return out.unionByName(untimed)


def split_late(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Results of a machine that reports late positions, and these positions: keys, reason, t_sec, event_id."""
    late = F.col(LATE[0]).isNotNull()
    return df.where(~late).drop(*LATE), df.where(late).select(*keys, *[F.col(c).alias(c[5:]) for c in LATE])
