"""Text and number forms of instants. Sessions are pinned to UTC (see session.configure)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"(Z|[+-]\d{2}(:?\d{2})?)"
_DATE = r"^(?!0000)\d{4}-\d{2}-\d{2}"
_ISO = rf"{_DATE}([T ]\d{{2}}:\d{{2}}:\d{{2}}(\.\d+)?{_OFFSET}?)?$"
_ISO_SHORT = rf"{_DATE}[T ]\d{{2}}(:\d{{2}})?{_OFFSET}?$"
_ISO_BASIC = rf"^(?!0000)\d{{8}}([T ]\d{{2}}(\d{{2}}(\d{{2}}([.,]\d+)?)?)?{_OFFSET}?)?$"
_ISSUE = (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}"
          r"(Z|[+-]\d{2}:?\d{2})$")
# First and last millisecond of the years 1 to 9999.
_MIN_MILLIS, _MAX_MILLIS = -62135596800000, 253402300799999


def _iso(text: Column) -> Column:
    """ISO 8601 text as an instant, NULL when it is not ISO 8601.

    The pattern comes first because a plain cast also takes ``2026`` or ``12:30``.
    """
    return F.when(text.rlike(_ISO), text.try_cast("timestamp")).otherwise(_unusual_iso(text))


def _unusual_iso(text: Column) -> Column:
    """Lower-case letters, decimal commas, times without seconds, and the form without separators."""
    text = F.replace(F.upper(text), F.lit(","), F.lit("."))
    extended = F.regexp_replace(F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3"),
                                r"([T ]\d{2})(\d{2})", "$1:$2")
    extended = F.regexp_replace(extended, r"([T ]\d{2}:\d{2})(\d{2})", "$1:$2")
    return (F.when(text.rlike(_ISO), text.try_cast("timestamp"))
            .when(text.rlike(_ISO_SHORT), _with_seconds(text).try_cast("timestamp"))
            .when(text.rlike(_ISO_BASIC), _with_seconds(extended).try_cast("timestamp")))


def _with_seconds(text: Column) -> Column:
    """Times cut after the hour or minute filled up; a cast takes no offset right after them."""
    minutes = F.regexp_replace(text, r"([T ]\d{2})(?=Z|[+-]|$)", "$1:00")
    return F.regexp_replace(minutes, r"([T ]\d{2}:\d{2})(?=Z|[+-]|$)", "$1:00")


def parse_iso(text: Column, field: str = "time") -> Column:
    """ISO 8601 as an instant (no offset means UTC); blank is NULL, malformed fails the job."""
    problem = F.raise_error(F.concat(F.lit(f"{field} is not an ISO 8601 time: "), text))
    return F.when(text != "", F.coalesce(_iso(F.trim(text)), problem))


def parse_issue_time(text: Column, field: str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.fff+zzzz`` as an instant; anything else fails the job, naming the field."""
    parsed = F.when(text.rlike(_ISSUE), text.try_cast("timestamp"))
    return F.when(text.isNotNull(), F.coalesce(
        parsed, F.raise_error(F.lit(f"field {field} is not an issue-tracker timestamp"))))


def to_time(text: Column) -> Column:
    """Epoch milliseconds (all digits) or ISO 8601 as an instant; anything else is NULL."""
    text = F.trim(text)
    millis = text.try_cast("bigint")
    return (F.when(text.rlike(_ISO), text.try_cast("timestamp"))
            .when(text.rlike(r"^-?\d+$"),
                  F.when(millis.between(_MIN_MILLIS, _MAX_MILLIS), F.timestamp_millis(millis)))
            .otherwise(_unusual_iso(text)))


def minute_in_zone(instant: Column, zone: str) -> Column:
    """``yyyy-MM-dd HH:mm`` of the instant in a named zone, seconds dropped."""
    return F.date_format(F.from_utc_timestamp(instant, zone), "yyyy-MM-dd HH:mm")


def utc_millis_text(instant: Column) -> Column:
    """UTC ISO 8601 with milliseconds, truncated."""
    return F.date_format(F.date_trunc("millisecond", instant), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
