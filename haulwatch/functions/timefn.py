"""Time helpers on timestamp_ntz columns; nothing here depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp_ntz."""
    return F.timestamp_diff("SECOND", F.expr(EPOCH), ts)


def from_seconds(sec: Column) -> Column:
    """timestamp_ntz of whole seconds since 1970-01-01."""
    return F.timestamp_add("SECOND", sec, F.expr(EPOCH))


def time_text(sec: Column) -> Column:
    """Whole seconds since 1970-01-01 to 'yyyy-MM-dd HH:mm:ss' text."""
    return F.date_format(from_seconds(sec), TIME_FORMAT)


def parse_time(text: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text to timestamp_ntz, null when it is no time."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT)).cast("timestamp_ntz")


def clock_seconds(text: Column) -> Column:
    """'HH:mm' or 'HH:mm:ss' to seconds of the day."""
    part = F.split(text, ":")

    def num(i: int) -> Column:
        return F.coalesce(F.get(part, F.lit(i)).try_cast("int"), F.lit(0))

    return F.when(text.isNotNull(), num(0) * 3600 + num(1) * 60 + num(2))


def second_of_day(sec: Column) -> Column:
    return F.pmod(sec, F.lit(86400)).cast("int")


def day_number(sec: Column) -> Column:
    """Days since 1970-01-01."""
    return F.floor(sec / 86400).cast("int")


def in_time_range(sec: Column, begin: Column, end: Column) -> Column:
    """Time of day strictly between two clock texts; begin after end wraps past midnight."""
    t, b, e = second_of_day(sec), clock_seconds(begin), clock_seconds(end)
    return F.when(b > e, (t < e) | (t > b)).otherwise((t > b) & (t < e))


def in_effective_date(sec: Column, begin: Column, end: Column) -> Column:
    """Closed date-time range, compared at minute precision."""
    def minute(text: Column) -> Column:
        ts = F.try_to_timestamp(F.substring(text, 1, 16), F.lit("yyyy-MM-dd HH:mm"))
        return F.floor(epoch_seconds(ts.cast("timestamp_ntz")) / 60)

    return F.floor(sec / 60).between(minute(begin), minute(end))


def whole_units(seconds: Column, unit: int) -> Column:
    """Integer division that truncates toward zero."""
    return (seconds / unit).cast("long")


def duration_text(seconds: Column, strict: bool = False) -> Column:
    """'H小时M分' or 'M分'. ``strict`` keeps the historic text, where the minutes of a
    duration of an hour or more are really its seconds."""
    hours = whole_units(seconds, 3600)
    minutes = whole_units(seconds, 60)
    rest = (seconds if strict else minutes) % 60
    return F.when(
        hours >= 1, F.concat(hours.cast("string"), F.lit("小时"), rest.cast("string"), F.lit("分"))
    ).otherwise(F.concat(minutes.cast("string"), F.lit("分")))


def partition_columns(ts: Column) -> dict[str, Column]:
    """Table partition values: 'yyyy-MM', unpadded day, unpadded hour."""
    return {
        "month_id": F.date_format(ts, "yyyy-MM"),
        "day_id": F.dayofmonth(ts).cast("string"),
        "hour_id": F.hour(ts).cast("string"),
    }
