"""Zone-free time arithmetic on ``timestamp_ntz`` columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The date partition that stored tables keep next to a time column.
PARTITION_OF = {"CaptureTime": "capture_date", "StartedAt": "started_date"}


def ntz(moment: datetime) -> Column:
    """A literal that does not depend on the session or the driver time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def now_or(as_of: datetime | None, column: str = "CaptureTime") -> Column:
    """The explicit moment if one is given, else the moment the row was captured."""
    return ntz(as_of) if as_of is not None else F.col(column)


def rows_from(df: DataFrame, column: str, moment: datetime) -> DataFrame:
    """Rows at or after a moment; on a stored table older date partitions are not read."""
    day = PARTITION_OF[column]
    bounded = df.filter(F.col(day) >= F.lit(moment.date())) if day in df.columns else df
    return bounded.filter(F.col(column) >= ntz(moment))


def rows_before(df: DataFrame, column: str, moment: datetime) -> DataFrame:
    """Rows before a moment; on a stored table younger date partitions are not read."""
    day = PARTITION_OF[column]
    bounded = df.filter(F.col(day) <= F.lit(moment.date())) if day in df.columns else df
    return bounded.filter(F.col(column) < ntz(moment))


def to_second(ts: Column) -> Column:
    """Cut to whole seconds; truncation functions would go through the session zone."""
    fraction = F.extract(F.lit("SECOND"), ts) % 1
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries between two moments: 10:59 to 11:01 counts one."""
    days = F.datediff(end.cast("date"), start.cast("date"))
    return (days * 24 + F.hour(end) - F.hour(start)).cast("int")


def minutes_crossed(start: Column, end: Column) -> Column:
    return hours_crossed(start, end).cast("bigint") * 60 + F.minute(end) - F.minute(start)


def seconds_crossed(start: Column, end: Column) -> Column:
    return minutes_crossed(start, end) * 60 + F.second(end) - F.second(start)


def millis_crossed(start: Column, end: Column) -> Column:
    def milli_of_minute(ts: Column) -> Column:
        return F.floor(F.extract(F.lit("SECOND"), ts) * 1000)

    return minutes_crossed(start, end) * 60000 + milli_of_minute(end) - milli_of_minute(start)


def decode_date_time(date: Column, time: Column) -> Column:
    """Integer yyyymmdd and hhmmss to a moment; NULL when they name no real one."""
    valid = date.between(10000101, 99991231) & time.between(0, 235959) & (time % 100 < 60)
    moment = F.try_make_timestamp_ntz(
        _div(date, 10000), _div(date, 100) % 100, date % 100,
        _div(time, 10000), _div(time, 100) % 100, (time % 100).cast("decimal(8,6)"),
    )
    return F.when(valid, moment)


def decode_duration(duration: Column) -> Column:
    """Integer hhmmss to seconds."""
    return (_div(duration, 10000) * 3600 + _div(duration % 10000, 100) * 60 + duration % 100).cast("int")


def _div(value: Column, by: int) -> Column:
    # Column has no integer division operator, so floor the exact quotient of small integers.
    return F.floor(value / F.lit(by)).cast("int")
