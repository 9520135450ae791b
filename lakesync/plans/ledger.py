"""The state table of a job with several objects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.operators import state
from lakesync.operators.windows import from_micros, instant
from lakesync.plans.merge import RowLevelStore
from lakesync.plans.store import TableStore
from lakesync.schemas import TableSpec


@dataclass(frozen=True)
class Step:
    mode: str
    watermark: datetime | None
    note: str | None


class Ledger:
    """One row per object. Tables stay this small, so plans are collected and rewrites are whole."""

    def __init__(self, store: TableStore, spec: TableSpec):
        # one unbucketed file, whatever the layout of the data tables
        self.store = store if isinstance(store, RowLevelStore) else TableStore(
            store.spark, store.namespace, store.provider, None, store.run_id)
        self.spec = spec
        self.store.ensure(spec)

    def read(self) -> DataFrame:
        return self.store.read(self.spec.name)

    def plan(self, objects: Sequence[str], full: bool, **rules) -> dict[str, Step]:
        names = self.store.spark.createDataFrame([(n,) for n in objects], "object_name string")
        plan = state.state_plan(names, self.read(), full, **rules)
        rows = plan.select("object_name", "mode", "note", F.unix_micros("watermark").alias("at")).collect()
        return {r["object_name"]: Step(r["mode"], from_micros(r["at"]), r["note"]) for r in rows}

    def success(self, name: str, mode: str, rows: int, watermark: datetime | None, run_at: datetime) -> None:
        self._put(state.record_success, name, mode, run_at, rows, watermark, None)

    def failure(self, name: str, mode: str, error: str, run_at: datetime) -> None:
        self._put(state.record_failure, name, mode, run_at, None, None, error)

    def _put(self, record, name: str, mode: str, run_at: datetime, rows: int | None,
             watermark: datetime | None, error: str | None) -> None:
        outcome = self.store.spark.range(1).select(
            F.lit(name).alias("object_name"), instant(watermark).alias("watermark"), F.lit(mode).alias("last_mode"),
            F.lit(rows).cast("bigint").alias("last_rows"), instant(run_at).alias("last_run_at"),
            F.lit(error).cast("string").alias("last_error"))
        self.store.replace_all(self.spec, record(self.read(), outcome), dedup=False)
