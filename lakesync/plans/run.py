"""Jobs of several objects: an object is a description of its change, what became of it is a row of a report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from lakesync.operators import apply, quality
from lakesync.operators.state import failures
from lakesync.operators.windows import micros
from lakesync.plans.ledger import Ledger, Step
from lakesync.plans.store import SEQ, TableStore, Written
from lakesync.schemas import TableSpec

REPORT = "object string, mode string, status string, rows bigint, watermark timestamp, note string, error string"
_ERROR_LENGTH = 1000


def wants_full(mode: str | None, usual: str = "incremental") -> bool:
    """A blank mode is the usual one; any other word than that or ``full`` is refused."""
    word = (mode or "").strip().lower()
    if word in ("", usual):
        return False
    if word == "full":
        return True
    raise ValueError(f"unknown mode {mode!r}: use {usual} or full")


def started(now: datetime | None) -> datetime:
    return datetime.now(timezone.utc) if now is None else now


@dataclass(frozen=True)
class Change:
    """What an object's run does to its table.

    ``gates`` are frames of faults by what they mean: any row in one, and
    nothing is written. ``lacking`` says what could not be part of ``rows``;
    it fails the object after the write.
    """

    spec: TableSpec
    rows: DataFrame
    whole: bool = False  # the table becomes the rows
    unique: bool = False  # the rows hold each key once
    marks: DataFrame | None = None  # ids to flag archived
    parents: DataFrame | None = None  # parents whose rows give way
    gates: Mapping[str, DataFrame] = field(default_factory=dict)
    reached: Callable[[Written], datetime | None] = lambda written: written.newest
    note: Callable[[], str | None] = lambda: None
    lacking: str = ""


def applied(old: DataFrame, change: Change) -> DataFrame:
    """The table after a change, as one plan; what ``commit`` leaves behind."""
    spec, tie = change.spec, [SEQ] if SEQ in change.rows.columns else []
    if change.whole:
        rows = change.rows if change.unique else apply.overwrite(change.rows, spec.key, spec.order_by, tie)
        return rows.drop(SEQ)
    if change.parents is not None:
        return apply.replace_by_parent(old, change.rows, change.parents, spec.parent, spec.key, spec.order_by, tie)
    new = apply.upsert(old, change.rows, spec.key, spec.order_by, tie, change.unique)
    return new if change.marks is None else apply.flag_archived(new, change.marks)


def commit(store: TableStore, change: Change) -> Written:
    for meaning, faults in change.gates.items():
        quality.fail_on(faults, meaning)
    if change.whole:
        return store.replace_all(change.spec, change.rows, dedup=not change.unique)
    if change.parents is not None:
        return store.replace_by_parent(change.spec, change.rows, change.parents)
    return store.upsert(change.spec, change.rows, change.marks, change.unique)


def run_objects(store: TableStore, ledger: Ledger, plan: Mapping[str, Step],
                changes: Mapping[str, Callable[[Step], Change]], run_at: datetime) -> DataFrame:
    """Commit each planned object and return the report; an object that fails keeps its watermark and stops no other."""
    rows = []
    for name, step in plan.items():
        count, reached, notes, error = 0, step.watermark, [step.note], None
        try:
            change = changes[name](step)
            written = commit(store, change)
            if change.lacking:
                raise RuntimeError(f"{change.lacking} ({written.rows} rows of the others are written)")
            count, reached = written.rows, change.reached(written) or step.watermark
            notes.append(change.note())
            ledger.success(name, step.mode, count, reached, run_at)
        except Exception as failure:  # it goes into the report and the state; the other objects still run
            count, reached, error = 0, step.watermark, (str(failure) or type(failure).__name__)[:_ERROR_LENGTH]
            with suppress(Exception):  # the report says it either way
                ledger.failure(name, step.mode, error, run_at)
        rows.append((name, step.mode, "FAILED" if error else "SUCCESS", count, None if reached is None else micros(reached),
                     "; ".join(note for note in notes if note) or None, error))
    held = store.spark.createDataFrame(rows, REPORT.replace("timestamp", "bigint"))
    return held.selectExpr("object", "mode", "status", "rows", "timestamp_micros(watermark) AS watermark", "note", "error")


def require_success(report: DataFrame) -> None:
    """Fail the job if any object failed."""
    quality.fail_on(failures(report).select("object", "error"), "objects failed")


def selected(names: Sequence[str], wanted: Sequence[str]) -> list[str]:
    return [name for name in names if name in wanted]
