"""Greedy chains: from an opening row jump to the first later row that qualifies, close there,
open again, and so on. Trips and alarm thinning are of this kind.

Where a chain goes depends on where it came from, so a key cannot simply be cut. But whatever
state reaches a chunk, it can only close at one of a few rows: a row of the chunk's first ``gap``
seconds, the first row after them, or the first row after that with another label. So the job
has three steps, all of them on (key, chunk) groups or on summaries of chunks:

1. every chunk lists those rows and the state in which the chain would leave the chunk;
2. per key, the summaries are folded in time order, which gives every chunk its entry state;
3. every chunk is walked from its entry state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.operators.ordered import DAY, with_chunk
from haulwatch.session import dealt

NONE = -1
NO_TIME = np.iinfo(np.int64).min

# Executors get the functions of this module themselves, not a reference to an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class ChainRule:
    """``gap``: seconds that must have passed since the opening row. ``other_label``: the closing
    row must have another label. ``reopen``: 'same' if the closing row opens the next link,
    'next' if the row after it does."""

    gap: int
    other_label: bool
    reopen: str


class _Block:
    """Whole (key, chunk) groups of sorted rows with the pointers of their chains."""

    def __init__(self, table: pa.Table, keys: list[str], rule: ChainRule):
        self.table, self.rule = table, rule
        n = table.num_rows
        col = {c: table.column(c).to_numpy(zero_copy_only=False) for c in [*keys, "_chunk", "_t", "_seq"]}
        change = np.zeros(n, dtype=bool)
        change[0] = True
        for c in [*keys, "_chunk"]:
            change[1:] |= col[c][1:] != col[c][:-1]
        self.t, self.seq = col["_t"].astype(np.int64), col["_seq"]
        self.starts = np.flatnonzero(change)
        self.group = np.cumsum(change) - 1
        self.reset = table.column("_reset").to_numpy(zero_copy_only=False).astype(bool)
        self.halo = table.column("_halo").to_numpy(zero_copy_only=False).astype(bool)
        self.label_text = table.column("_label").to_pandas().to_numpy(dtype=object)
        self.label = pd.factorize(self.label_text)[0]
        bounds = np.append(self.starts, n)
        halo_before = np.concatenate([[0], np.cumsum(self.halo)])
        self.all_ends = bounds[1:]
        self.ends = bounds[1:] - (halo_before[bounds[1:]] - halo_before[bounds[:-1]])
        self.n = n
        # First index at or after i with another label / a reset row / a row that is no reset.
        shifted = np.ones(n, dtype=bool)
        if rule.other_label:
            shifted[1:] = self.label[1:] != self.label[:-1]
        self._label_change = np.flatnonzero(shifted)
        self._resets = np.flatnonzero(self.reset)
        self._plain = np.flatnonzero(~self.reset)
        base = self.t.min()
        self._span = int(self.t.max() - base) + rule.gap + 2
        self._base = base
        self._axis = self.group * self._span + (self.t - base)
        index = np.arange(n)
        end = self.ends[self.group]
        due = self._at(self.group, self.t + rule.gap)
        due = self._skip_label(due, self.label)
        closing = np.minimum(due, self._next(self._resets, index + 1))
        closing = np.where(closing < end, closing, NONE)
        # What happens after closing at a row, for every row; and where each row's chain closes.
        self.reopen = self._reopen(index)
        self.closing = closing
        self.following = np.where(closing == NONE, NONE, self.reopen[closing])
        # Per group: first reset, first row that is none, first row that is due for any state,
        # first row after that with another label.
        starts, groups = self.starts, np.arange(len(self.starts))
        self.stop = self._next(self._resets, starts)
        self.plain = self._next(self._plain, starts)
        late = self._at(groups, self.t[starts] + rule.gap)
        other = self._skip_label(late, self.label[np.minimum(late, n - 1)])
        self.late, self.other = late, other
        # A group's first row that is no reset, if it has one.
        self.first_plain = np.where(self.plain < self.ends, self.plain, NONE)

    def _next(self, where: np.ndarray, index: np.ndarray) -> np.ndarray:
        pos = np.searchsorted(where, index)
        return np.append(where, self.n)[pos]

    def _at(self, group: np.ndarray, t: np.ndarray) -> np.ndarray:
        """First index of the group at or after time t (may lie past the group's end)."""
        offset = np.clip(t - self._base, 0, self._span - 1)
        return np.searchsorted(self._axis, group * self._span + offset)

    def _skip_label(self, index: np.ndarray, label: np.ndarray) -> np.ndarray:
        if not self.rule.other_label:
            return index
        inside = np.minimum(index, self.n - 1)
        same = (index < self.n) & (self.label[inside] == label)
        return np.where(same, self._next(self._label_change, index + 1), index)

    def _reopen(self, closing: np.ndarray) -> np.ndarray:
        step = 0 if self.rule.reopen == "same" else 1
        after = self._next(self._plain, closing + step)
        opener = np.where(self.reset[closing], closing, after)
        return np.where(opener < self.ends[self.group[closing]], opener, NONE)

    def last_openers(self) -> np.ndarray:
        """For a chain that opens at i: where its last link of the chunk opens, or NONE. Pointers to the next opener
        are doubled until they stay: a chain of k links takes log k rounds over whole arrays."""
        index = np.arange(self.n + 1)
        jump = np.append(np.where(self.closing == NONE, index[:-1], np.where(self.following == NONE, self.n, self.following)), self.n)
        while True:
            further = jump[jump]
            if np.array_equal(further, jump):
                return np.where(jump[:-1] == self.n, NONE, jump[:-1])
            jump = further

    def openers(self, first: np.ndarray) -> np.ndarray:
        """All rows at which the chains that open at ``first`` open a link, in order; doubled pointers reach 2, 4, 8
        links in as many rounds."""
        reached = np.zeros(self.n + 1, dtype=bool)
        reached[first] = True
        jump = np.append(np.where(self.following == NONE, self.n, self.following), self.n)
        at = np.unique(first)
        while True:
            new = np.unique(jump[at])
            new = new[(new < self.n) & ~reached[new]]
            if not len(new):
                return np.flatnonzero(reached[:-1])
            reached[new] = True
            at = np.flatnonzero(reached[:-1])
            jump = jump[jump]

    def entry_closings(self, in_t: np.ndarray, in_label: list) -> np.ndarray:
        """Per group, where a state that was open before the chunk closes."""
        groups = np.arange(len(self.starts))
        codes = {v: c for v, c in zip(self.label_text, self.label)}
        code = np.array([-1 if v is None else codes.get(v, -2) for v in in_label])
        due = np.maximum(self._at(groups, in_t + self.rule.gap), self.starts)
        due = np.minimum(self._skip_label(due, code), self._next(self._resets, self.starts))
        return np.where(due < self.ends, due, NONE)

    def listed(self) -> tuple[np.ndarray, np.ndarray]:
        """Group, row of the only rows at which an earlier state can close: those before the first one that is due
        for any state, this one, the first one after it with another label, and the first reset; none behind it."""
        full = np.flatnonzero(self.starts < self.ends)
        upto = np.minimum(self.late, self.ends)
        count = np.maximum(upto - self.starts, 0)
        group = np.repeat(full, count[full])
        offset = np.arange(len(group)) - np.repeat(np.cumsum(count[full]) - count[full], count[full])
        parts = [(group, self.starts[group] + offset)]
        due = full[self.late[full] < self.ends[full]]
        parts.append((due, self.late[due]))
        if self.rule.other_label:
            other = due[self.other[due] < self.ends[due]]
            parts.append((other, self.other[other]))
        groups, rows = (np.concatenate(x) for x in zip(*parts))
        before = rows <= self.stop[groups]
        groups, rows = groups[before], rows[before]
        reset = full[self.stop[full] < self.ends[full]]
        groups, rows = np.concatenate((groups, reset)), np.concatenate((rows, self.stop[reset]))
        rows, first = np.unique(rows, return_index=True)
        return groups[first], rows

    def worked_until(self, index: np.ndarray) -> np.ndarray:
        """Times of the last rows with the opener's label less than ``gap`` after it and before any reset; NO_TIME if
        there is none."""
        if not self.rule.other_label:
            return np.full(len(index), NO_TIME)
        group = self.group[index]
        end = np.minimum(self._at(group, self.t[index] + self.rule.gap), self.all_ends[group])
        end = np.minimum(end, self._next(self._resets, index + 1))
        order = np.lexsort((np.arange(self.n), self.label))
        places = self.label[order].astype(np.int64) * (self.n + 1) + order
        at = np.searchsorted(places, self.label[index].astype(np.int64) * (self.n + 1) + end) - 1
        last = order[np.maximum(at, 0)]
        return np.where((at >= 0) & (self.label[last] == self.label[index]) & (last > index), self.t[last], NO_TIME)


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that end at a group boundary; at most one group is held back."""
    held: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        tail = [table.column(c).to_numpy(zero_copy_only=False) for c in keys]
        cut = table.num_rows
        while cut > 0 and all(c[cut - 1] == c[-1] for c in tail):
            cut -= 1
        if cut > 0 or (
            held and any(held[-1].column(c)[-1].as_py() != table.column(c)[0].as_py() for c in keys)
        ):
            yield pa.concat_tables([*held, table.slice(0, cut)])
            held = [table.slice(cut)]
        else:
            held.append(table)
    if held:
        yield pa.concat_tables(held)


class _Leaving:
    """First known ``_out`` time from a row on, inside its group."""

    def __init__(self, block: _Block):
        raw = block.table.column("_out").to_pandas()
        known = np.flatnonzero(raw.notna().to_numpy() & ~block.halo)
        at = np.append(known, block.n)[np.searchsorted(known, np.arange(block.n))]
        self.at = np.where(at < block.ends[block.group], at, block.n)
        self.times = np.append(raw.fillna(NO_TIME).to_numpy().astype(np.int64), NO_TIME)
        self.n = block.n

    def after(self, index: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        found = self.at[index]
        if before is not None:
            found = np.where(found < before, found, self.n)
        return self.times[found]


def _states(block: _Block, index: np.ndarray, leaving: _Leaving) -> list[pa.Array]:
    """State after opening at each row (NONE: none is open): whether one is, its time, seq, label and leave time."""
    has = index != NONE
    at = np.where(has, index, 0)
    return [
        pa.array(has), pa.array(block.t[at], mask=~has), pa.array(block.seq[at].astype(np.int64), mask=~has),
        pa.array(block.label_text[at], pa.string(), mask=~has), _times(np.where(has, leaving.after(at), NO_TIME))]


def _times(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == NO_TIME)


LONG, TEXT, FLAG, INT = (
    (T.LongType(), pa.int64()), (T.StringType(), pa.string()), (T.BooleanType(), pa.bool_()),
    (T.IntegerType(), pa.int32()),
)
SUMMARY = {
    "_row": INT, "_t": LONG, "_label": TEXT, "_reset": FLAG, "has": FLAG, "open_t": LONG,
    "open_seq": LONG, "open_label": TEXT, "open_leave": LONG,
}
ENTRY = {"in_t": LONG, "in_seq": LONG, "in_label": TEXT, "in_leave": LONG}
LINK = {"role": TEXT, "link_t": LONG, "link_seq": LONG, "worked_t": LONG, "leave_t": LONG}


def _spark_type(fields: list[T.StructField], extra: dict) -> T.StructType:
    return T.StructType(fields + [T.StructField(n, t[0]) for n, t in extra.items()])


def _emit(head: pa.Table, columns: list, extra: dict) -> list[pa.RecordBatch]:
    """``head``'s columns next to these, as record batches."""
    arrays = [head.column(c).combine_chunks() for c in head.column_names]
    arrays += [c.cast(t[1]) if isinstance(c, pa.Array) else pa.array(c, type=t[1]) for c, t in zip(columns, extra.values())]
    return pa.Table.from_arrays(arrays, names=[*head.column_names, *extra]).to_batches()


def _summarise(keys: list[str], rule: ChainRule):
    group_cols = [*keys, "_chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, group_cols):
            block = _Block(table, keys, rule)
            last, leaving = np.append(block.last_openers(), NONE), _Leaving(block)
            full = np.flatnonzero(block.starts < block.ends)
            if not len(full):
                continue
            # Row -1: the way of a chain that comes without a state, and the first out time.
            fresh = last[block.first_plain[full]]
            groups, rows = block.listed()
            after = last[block.reopen[rows]]
            none = np.zeros(len(full), bool)
            number = np.arange(len(rows)) - np.searchsorted(groups, groups)
            source = block.starts[np.concatenate((full, groups))]
            columns = [
                np.concatenate((np.full(len(full), -1), number)),
                _times(np.concatenate((leaving.after(block.starts[full]), block.t[rows]))),
                pa.array(np.concatenate((np.full(len(full), None, object), block.label_text[rows])), pa.string()),
                np.concatenate((none, block.reset[rows])), *_states(block, np.concatenate((fresh, after)), leaving)]
            yield from _emit(table.select(group_cols).take(pa.array(source)), columns, SUMMARY)

    return run


def _fold(keys: list[str], rule: ChainRule):
    """Entry state of every chunk of a key, from the summaries in time order. Holds one state,
    and the listed rows of one chunk, at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = chunk = None
        state = entry = fresh = out_time = None
        closed = False
        for batch in batches:
            found, source = [], []
            for at, r in enumerate(batch.to_pylist()):
                this_key = tuple(r[k] for k in keys)
                if this_key != key or r["_chunk"] != chunk:
                    if this_key != key:
                        state = None
                    elif not closed:
                        state = _passed(entry, fresh, out_time)
                    key, chunk, entry, closed = this_key, r["_chunk"], state, False
                    if entry is not None:
                        found.append(entry)
                        source.append(at)
                after = (
                    (r["open_t"], r["open_seq"], r["open_label"], r["open_leave"]) if r["has"] else None
                )
                if r["_row"] < 0:
                    fresh, out_time = after, r["_t"]
                elif entry is not None and not closed:
                    due = r["_t"] >= entry[0] + rule.gap
                    fits = not rule.other_label or r["_label"] != entry[2]
                    if r["_reset"] or (due and fits):
                        state, closed = after, True
            if found:
                head = pa.Table.from_batches([batch]).select([*keys, "_chunk"])
                yield from _emit(head.take(pa.array(source)), [list(c) for c in zip(*found)], ENTRY)

    return run


def _passed(entry: tuple | None, fresh: tuple | None, out_time: int | None) -> tuple | None:
    """State after a chunk in which the entry state did not close."""
    if entry is None:
        return fresh
    return (*entry[:3], entry[3] if entry[3] is not None else out_time)


def _walk(keys: list[str], rule: ChainRule, payload: list[str]):
    group_cols = [*keys, "_chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, group_cols):
            block = _Block(table, keys, rule)
            leaving = _Leaving(block)
            heads = table.select(list(ENTRY)).take(pa.array(block.starts)).to_pydict()
            came = np.array([v is not None for v in heads["in_t"]], dtype=bool)
            entered = np.array([0 if v is None else v for v in heads["in_t"]], dtype=np.int64)
            in_seq = np.array([0 if v is None else v for v in heads["in_seq"]], dtype=np.int64)
            in_leave = np.array([NO_TIME if v is None else v for v in heads["in_leave"]], dtype=np.int64)
            closings = block.entry_closings(entered, heads["in_label"])
            full = block.starts < block.ends
            # A state that came in closes at a row, and what opens then; a chain without one opens at the first row.
            closed = np.flatnonzero(full & came & (closings != NONE))
            first = np.concatenate((block.first_plain[full & ~came], block.reopen[closings[closed]]))
            ended = closed[~block.reset[closings[closed]]]
            at = closings[ended]
            leave = np.where(in_leave[ended] != NO_TIME, in_leave[ended], leaving.after(block.starts[ended], at))
            opened = block.openers(first[first != NONE])
            done = opened[block.closing[opened] != NONE]
            done = done[~block.reset[block.closing[done]]]
            ends = block.closing[done]
            picked = np.concatenate((at, opened, ends))
            if not len(picked):
                continue
            none = lambda n: np.full(n, NO_TIME)
            links = [
                ["close"] * len(at) + ["open"] * len(opened) + ["close"] * len(done),
                np.concatenate((entered[ended], block.t[opened], block.t[done])),
                np.concatenate((in_seq[ended], block.seq[opened].astype(np.int64), block.seq[done].astype(np.int64))),
                _times(np.concatenate((none(len(at)), block.worked_until(opened), none(len(done))))),
                _times(np.concatenate((leave, none(len(opened)), leaving.after(done, ends))))]
            yield from _emit(table.select([*keys, *payload]).take(pa.array(picked)), links, LINK)

    return run


def greedy_chain(
    df: DataFrame, keys: list[str], rule: ChainRule, label: str | None = None,
    reset: str | None = None, out: str | None = None,
    order: tuple[str, str] = ("t_sec", "event_id"), width: int = DAY,
) -> DataFrame:
    """The rows at which links open and close.

    ``role`` is 'open' or 'close'; ``link_t``/``link_seq`` are the order columns of the link's
    opening row, the same for both rows of a link. ``worked_t`` (on 'open') is the last time the
    opener's label was seen within ``gap``; ``leave_t`` (on 'close') is the first ``out`` time
    from the opening to the closing row. A ``reset`` row replaces an open state by itself
    without closing it, and is ignored while nothing is open. Rows without a key or a place in
    the order are left out."""
    payload = df.columns
    gap = rule.gap
    base = df.dropna(subset=[*keys, *order]).withColumns(
        {
            "_t": F.col(order[0]).cast("long"),
            "_seq": F.col(order[1]).cast("long"),
            "_label": F.col(label).cast("string") if label else F.lit(None).cast("string"),
            "_reset": F.coalesce(F.col(reset), F.lit(False)) if reset else F.lit(False),
            "_out": F.col(out).cast("long") if out else F.lit(None).cast("long"),
        }
    )
    base = with_chunk(base, width, "_t")
    if rule.other_label:
        # The first seconds of a chunk are also shown, read-only, to the chunk before it.
        early = F.pmod(F.col("_t"), F.lit(width)) < gap
        copies = F.when(early, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        base = base.withColumn("_halo", F.explode(copies)).withColumn(
            "_chunk", F.col("_chunk") - F.col("_halo").cast("long")
        )
    else:
        base = base.withColumn("_halo", F.lit(False))
    groups = [*keys, "_chunk"]
    spread = dealt(base, *groups)
    key_fields = [base.schema[c] for c in groups]

    # Steps 1 and 3 read the same columns, so that Spark shuffles the rows once for both.
    summaries = spread.sortWithinPartitions(*groups, "_t", "_seq").mapInArrow(
        _summarise(keys, rule), _spark_type(key_fields, SUMMARY)
    )
    entries = (
        summaries.repartition(*keys)
        .sortWithinPartitions(*groups, "_row")
        .mapInArrow(_fold(keys, rule), _spark_type(key_fields, ENTRY))
    )
    rest = [c for c in payload if c not in keys]
    link_type = _spark_type([base.schema[c] for c in [*keys, *rest]], LINK)
    return (
        spread.join(entries, groups, "left")
        .sortWithinPartitions(*groups, "_t", "_seq")
        .mapInArrow(_walk(keys, rule, rest), link_type)
    )
