"""Change windows over a time column.

Bounds are driver-side instants turned into literals of the column's own type,
so the comparison reaches the file scan. A bound of ``None`` is no bound.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def utc(value: datetime) -> datetime:
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def micros(value: datetime) -> int:
    return (utc(value) - _EPOCH) // timedelta(microseconds=1)


def from_micros(value: int | None) -> datetime | None:
    return None if value is None else _EPOCH + timedelta(microseconds=value)


def instant(value: datetime | None) -> Column:
    if value is None:
        return F.lit(None).cast("timestamp")
    return F.timestamp_micros(F.lit(micros(value)))


def instant_micros(column: Column) -> Column:
    """Epoch microseconds of a time column, with or without a zone."""
    return F.unix_micros(column.cast("timestamp"))


def overlapped(since: datetime | None, overlap_seconds: int) -> datetime | None:
    return None if since is None else utc(since) - timedelta(seconds=overlap_seconds)


def _bound(df: DataFrame, column: str, value: datetime) -> Column:
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        # as text: a naive datetime would be taken in the Python process's own zone
        return F.lit(utc(value).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return instant(value)


def _between(df: DataFrame, column: str, lower: datetime | None, upper: datetime | None,
             include_upper: bool) -> DataFrame:
    if lower is not None:
        df = df.filter(F.col(column) >= _bound(df, column, lower))
    if upper is not None:
        bound = _bound(df, column, upper)
        df = df.filter(F.col(column) <= bound if include_upper else F.col(column) < bound)
    return df


def closed(df: DataFrame, column: str, since: datetime | None, until: datetime | None,
           overlap_seconds: int = 300) -> DataFrame:
    """``since - overlap <= column <= until``; without ``since`` everything, NULL times included.

    Bounds are cut to the millisecond, as the source compares them.
    """
    if since is None:
        return df
    lower = _to_millis(overlapped(since, overlap_seconds))
    return _between(df, column, lower, _to_millis(until), include_upper=True)


def by_minute(df: DataFrame, column: str, since: datetime | None, until: datetime,
              overlap_seconds: int = 300) -> DataFrame:
    """Closed window whose bounds are cut to the minute; the upper one always applies."""
    lower = overlapped(since, overlap_seconds)
    return _between(df, column, _to_minute(lower), _to_minute(until), include_upper=True)


def half_open(df: DataFrame, column: str, since: datetime, until: datetime,
              overlap_seconds: int = 300) -> DataFrame:
    """``since - overlap <= column < until``, bounds cut to the millisecond."""
    lower = _to_millis(overlapped(since, overlap_seconds))
    return _between(df, column, lower, _to_millis(until), include_upper=False)


def open_ended(df: DataFrame, column: str, since: datetime | None, overlap_seconds: int = 0) -> DataFrame:
    """``column >= since - overlap``; rows without a time are never part of a change feed."""
    return _between(df.filter(F.col(column).isNotNull()), column, overlapped(since, overlap_seconds), None, True)


def _to_millis(value: datetime | None) -> datetime | None:
    return value and utc(value).replace(microsecond=utc(value).microsecond // 1000 * 1000)


def _to_minute(value: datetime | None) -> datetime | None:
    return value and utc(value).replace(second=0, microsecond=0)
