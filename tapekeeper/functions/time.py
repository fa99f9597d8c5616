"""Time helpers. Every function that needs "now" takes ``as_of``; None means the query's clock."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F


def instant(as_of=None) -> Column:
    """A timestamp column from a Column, an ISO string or datetime (without a zone: UTC), or None for now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        try:
            as_of = datetime.fromisoformat(as_of)
        except ValueError:
            return F.lit(as_of).cast("timestamp")
    if isinstance(as_of, datetime):
        as_of = (as_of.replace(tzinfo=timezone.utc) if as_of.tzinfo is None else as_of).isoformat()
    return F.lit(as_of).cast("timestamp")


def span(interval) -> Column:
    """An interval column from a timedelta or text such as ``"10 minutes"``."""
    return F.lit(interval) if isinstance(interval, timedelta) else F.expr(f"INTERVAL {interval}")


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries from start to end, so 0.9 s to 1.1 s is one; not elapsed time."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def to_millis(ts: Column) -> Column:
    """Cut a timestamp to whole milliseconds."""
    return F.timestamp_millis(F.unix_millis(ts))


def utc_day(ts: Column) -> Column:
    """The UTC date of a timestamp, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int"))


def from_utc_clock(wall: Column) -> Column:
    """A wall-clock value read as UTC, whatever the session's time zone."""
    return F.lit("1970-01-01T00:00:00Z").cast("timestamp") + (wall - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def to_utc_clock(ts: Column) -> Column:
    """A timestamp as its wall-clock value in UTC, whatever the session's time zone."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + (ts - F.lit("1970-01-01T00:00:00Z").cast("timestamp"))


def interval_start(ts: Column, interval: str) -> Column:
    """Start of the epoch-aligned interval that holds ``ts``."""
    return F.window(ts, interval)["start"]


def since(df: DataFrame, column: str, as_of=None, interval="10 minutes") -> DataFrame:
    """Rows strictly newer than ``as_of - interval``; rows from the future stay."""
    return df.filter(F.col(column) > instant(as_of) - span(interval))


def between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows inside a dashboard's time range, both ends included."""
    return df.filter(F.col(column).between(instant(low), instant(high)))
