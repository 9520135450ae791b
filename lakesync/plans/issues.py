"""One search result to one table, watermark read from the table itself."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame

from lakesync.mapping.issue import issue_rows
from lakesync.operators.dedup import newest
from lakesync.operators.paging import incomplete_listings
from lakesync.operators.windows import by_minute
from lakesync.plans.run import Change, commit, started, wants_full
from lakesync.plans.store import SEQ, TableStore
from lakesync.plans.tables import stored_watermark, table_mode
from lakesync.schemas import ISSUES
from lakesync.sources.landing import typed_issues


def changed_issues(records: DataFrame, since: datetime | None, until: datetime, overlap_seconds: int = 300,
                   where: Column | None = None) -> DataFrame:
    """Rows of issues updated inside the window and matching the caller's filter, copies included.

    The window is applied to the landed time, before anything else is parsed.
    """
    inside = by_minute(typed_issues(records), "modified", since, until, overlap_seconds)
    rows = issue_rows(inside, [c for c in (SEQ,) if c in records.columns])
    return rows if where is None else rows.filter(where)


def issue_change(records: DataFrame, since: datetime | None, until: datetime, whole: bool, overlap_seconds: int = 300,
                 where: Column | None = None, pages: DataFrame | None = None, name: str = ISSUES.name) -> Change:
    """The newest row of each changed issue.

    ``pages`` are the pages the records came on: ``listing``, ``token``,
    ``is_last`` and, if they landed with the cursor they answer, ``asked``. A
    listing that lacks a page, or does not say where it ends, fails the run.
    """
    changed = changed_issues(records, since, until, overlap_seconds, where)
    gates = {} if pages is None else {"a listing is not complete": incomplete_listings(pages)}
    rows = newest(changed, ISSUES.key, "updated", [c for c in (SEQ,) if c in changed.columns])
    return Change(replace(ISSUES, name=name), rows, whole=whole, unique=True, gates=gates)


def preview(records: DataFrame, limit: int = 10, where: Column | None = None) -> DataFrame:
    """The first issues in update order; writes nothing."""
    rows = issue_rows(records)
    rows = rows if where is None else rows.filter(where)
    return rows.orderBy("updated", "key").limit(limit)


def sync_issues(store: TableStore, records: DataFrame, table: str = "issues", mode: str | None = None,
                where: Column | None = None, overlap_seconds: int = 300, now: datetime | None = None,
                pages: DataFrame | None = None) -> dict[str, Any]:
    """First run: every matching issue. Later: those updated since the table's newest one, merged on key."""
    full = wants_full(mode)
    store.ensure_schema()
    exists = store.exists(table)
    since = stored_watermark(store, table, "updated") if exists and not full else None
    written = commit(store, issue_change(
        records, since, started(now), full or not exists, overlap_seconds, where, pages, table))
    return {"table": store.name(table), "mode": table_mode(store, full, exists, since),
            "since": since.isoformat() if since else None,
            "rows_read": written.rows, "rows_in_table": store.read(table).count()}
