"""Shared by the jobs that keep their watermark in the target table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakesync.operators.state import table_plan, watermark
from lakesync.operators.windows import from_micros, instant
from lakesync.plans.store import TableStore


def stored_watermark(store: TableStore, table: str, column: str) -> datetime | None:
    return from_micros(store.read(table).agg(watermark(column)).first()[0])


def table_mode(store: TableStore, full: bool, existed: bool, since: datetime | None) -> str:
    facts = store.spark.range(1).select(
        F.lit(full).alias("full_requested"), F.lit(existed).alias("table_exists"), instant(since).alias("watermark"))
    return table_plan(facts).first()["mode"]
