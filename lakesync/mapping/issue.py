"""Issue-tracker records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.functions.payload import RECORD, once, other_fields, text_at, with_record
from lakesync.functions.times import parse_issue_time
from lakesync.schemas import ISSUES

# Where each typed column sits below ``fields``.
_PATHS = {
    "summary": "summary", "status": "status.name", "priority": "priority.name",
    "assignee": "assignee.displayName", "reporter": "reporter.displayName",
    "issuetype": "issuetype.name", "project": "project.key",
}
_TIMES = ("created", "updated")


def requested_fields(extra: Sequence[str] = ()) -> list[str]:
    """Typed fields plus extra ones, each named once, in order."""
    return list(dict.fromkeys(["key", "updated", *_PATHS, "created", *extra]))


def issue_rows(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per issue; fields without a typed column end up in ``raw_fields``."""
    issue = F.col(RECORD)
    columns = {"key": text_at(issue, "key")}
    columns |= {name: text_at(issue, "fields." + path) for name, path in _PATHS.items()}
    columns |= {name: F.col("_" + name) for name in _TIMES}
    columns["raw_fields"] = other_fields(issue, "fields", ["key", *_PATHS, *_TIMES])
    # change windows compare `updated`, so it is worth having as a value
    times = {"_" + name: parse_issue_time(text_at(issue, "fields." + name), name) for name in _TIMES}
    return once(with_record(records), **times).select(*[columns[name].alias(name) for name in ISSUES.names], *keep)
