"""Per-object sync state: what to run next, and how a run is recorded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.operators.windows import instant_micros


def watermark(column: str) -> Column:
    """Newest instant of a column in epoch microseconds, NULL when there is none."""
    return F.max(instant_micros(F.col(column)))


def newest_or_kept(newest: Column, stored: Column) -> Column:
    """Newest edit of this run, else the watermark already stored."""
    return F.coalesce(newest, stored)


def shared_threshold(threshold: Column) -> Column:
    """Lowest of several thresholds; one object without a bound means no bound."""
    return F.when(F.count_if(threshold.isNull()) == 0, F.min(threshold))


def table_plan(objects: DataFrame) -> DataFrame:
    """Add ``mode`` for jobs whose watermark lives in the target.

    Reads ``full_requested``, ``table_exists`` and ``watermark``.
    """
    mode = (F.when(F.col("full_requested"), "full refresh")
            .when(~F.col("table_exists"), "full")
            .when(F.col("watermark").isNull(), "full re-read")
            .otherwise("incremental"))
    return objects.withColumn("mode", mode)


def state_plan(objects: DataFrame, state: DataFrame, full: bool, always_full: Sequence[str] = (),
               changed: str = "incremental", always_note: str = "no change tracking") -> DataFrame:
    """``objects`` (``object_name``) with ``mode``, ``watermark`` and ``note`` from the state table."""
    always = F.col("object_name").isin(*always_full) if always_full else F.lit(False)
    first = F.col("watermark").isNull()
    mode = F.when(always | F.lit(full) | first, "full").otherwise(changed)
    note = F.when(always, always_note).when(first & F.lit(not full), "first run")
    return (objects.join(state.select("object_name", "watermark"), "object_name", "left")
            .select(*objects.columns, "watermark", mode.alias("mode"), note.alias("note")))


def record_success(state: DataFrame, outcome: DataFrame) -> DataFrame:
    """State after successful objects: their whole row is replaced or added."""
    done = outcome.withColumn("last_status", F.lit("SUCCESS"))
    if "last_error" in state.columns:
        done = done.withColumn("last_error", F.lit(None).cast("string"))
    others = state.join(outcome.select("object_name"), "object_name", "left_anti")
    return others.select(*state.columns).unionByName(done.select(*state.columns))


def record_failure(state: DataFrame, outcome: DataFrame) -> DataFrame:
    """State after failed objects: the watermark stays.

    A state table with ``last_error`` also stores the error and 0 rows; one
    without keeps its last row count.
    """
    with_error = "last_error" in state.columns
    kept = {"watermark"} if with_error else {"watermark", "last_rows"}
    failed = (outcome.withColumn("last_status", F.lit("FAILED")).withColumn("watermark", F.lit(None))
              .withColumn("last_rows", F.lit(0 if with_error else None)))
    old, new = state.alias("old"), failed.alias("new")
    columns = [F.coalesce("old.object_name", "new.object_name").alias("object_name")]
    for name in state.columns[1:]:
        value = F.col("old." + name) if name in kept else F.when(
            F.col("new.object_name").isNull(), F.col("old." + name)).otherwise(F.col("new." + name))
        columns.append(value.cast(state.schema[name].dataType).alias(name))
    return old.join(new, F.col("old.object_name") == F.col("new.object_name"), "full").select(*columns)


def failures(report: DataFrame) -> DataFrame:
    return report.filter(F.col("status") != "SUCCESS")


def run_report(state: DataFrame) -> DataFrame:
    """One line per object from the stored state."""
    error = F.col("last_error") if "last_error" in state.columns else F.lit(None).cast("string")
    return state.select(
        F.col("object_name").alias("object"), F.col("last_mode").alias("mode"),
        F.col("last_status").alias("status"), F.col("last_rows").alias("rows"), "watermark", error.alias("error"))
