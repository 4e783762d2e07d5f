"""Date/time column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def naive_time_of_day(ts: Column) -> Column:
    """'HH:mm:ss' of a naive timestamp.  Taken from its string form, which
    (unlike ``date_format``) does not pass through the session time zone, so
    a wall-clock time inside a daylight-saving gap is kept as written."""
    return F.substring(ts.cast("string"), 12, 8)


def split_date_time(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Add ``date`` (calendar day) and ``time`` ('HH:mm:ss') after ``ts_col``."""
    naive = df.schema[ts_col].dataType.typeName() == "timestamp_ntz"
    time_of_day = (naive_time_of_day(F.col(ts_col)) if naive
                   else F.date_format(ts_col, "HH:mm:ss"))
    cols = []
    for c in df.columns:
        if c in ("date", "time"):
            continue
        cols.append(F.col(c))
        if c == ts_col:
            cols += [F.to_date(ts_col).alias("date"), time_of_day.alias("time")]
    return df.select(*cols)


def naive_epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a naive (TIMESTAMP_NTZ) value,
    independent of the session time zone.

    Casting a naive value to TIMESTAMP goes through the session zone, where a
    daylight-saving gap can reorder two wall-clock times; the count of days
    and the interval since midnight do not.  (The interval becomes a number
    as whole seconds of a million times itself, all in 64-bit integers.)
    """
    day = F.to_date(ts)
    since_midnight = (ts - day.cast("timestamp_ntz")) * F.lit(1_000_000)
    return (F.unix_date(day).cast("bigint") * 86_400_000_000
            + since_midnight.cast("interval second").cast("bigint"))


def floor_to_interval(ts: Column, minutes: int = 5) -> Column:
    """Start of the ``minutes``-wide bucket holding the naive timestamp
    ``ts`` (epoch-aligned), keeping its type."""
    width = minutes * 60 * 1_000_000
    return F.timestamp_add("MICROSECOND", -F.pmod(naive_epoch_micros(ts), F.lit(width)), ts)
