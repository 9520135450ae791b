"""Typed landing: what decides whether a record is read stands next to its payload, parsed once when it lands.

A landed table is partitioned by the day it landed, and a change window over
``modified`` or ``edited`` is a plain comparison that reaches its file scan.
Frames that bring the typed columns are taken as they are.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.functions.payload import RECORD, once, text_at, with_record
from lakesync.functions.times import parse_iso, parse_issue_time, to_time
from lakesync.mapping.crm import MODIFIED

DAY = "landed"


def typed_records(records: DataFrame, kind: str) -> DataFrame:
    """CRM records with ``id, modified, archived, archived_at``; the flag must be a JSON boolean to count."""
    if "modified" in records.columns:
        return records
    fields = F.from_json("payload", "id string, archived boolean, archivedAt string, properties map<string,string>")
    rows = once(records, _f=fields)
    return once(rows, id=F.col("_f.id"), modified=to_time(F.col("_f.properties")[MODIFIED[kind]]),
                archived=F.coalesce(F.col("_f.archived"), F.lit(False)), archived_at=to_time(F.col("_f.archivedAt"))).drop("_f")


def typed_objects(objects: DataFrame) -> DataFrame:
    """Workspace objects with ``kind`` and ``edited``; partial ones have no edit time."""
    if "edited" in objects.columns:
        return objects
    record = F.col(RECORD)
    rows = once(with_record(objects), kind=text_at(record, "object"),
                edited=parse_iso(text_at(record, "last_edited_time"), "last_edited_time"))
    return rows.drop(RECORD)


def typed_issues(records: DataFrame) -> DataFrame:
    """Issues with ``modified``, the time they were updated."""
    if "modified" in records.columns:
        return records
    return once(records, modified=parse_issue_time(F.get_json_object("payload", "$.fields.updated"), "updated"))


def land(typed: DataFrame, path: str, day: date) -> None:
    """Append typed records to a landed table; landing the same day again only adds files.

    Files hold ranges of kind and time and are sorted inside, so the least and
    greatest time of files, row groups and pages let a window skip the rest.
    Records of one instant are dealt by their content, so that it may hold any
    share of them.
    """
    by = [c for c in ("kind", "modified", "edited") if c in typed.columns]
    if by:
        typed = typed.repartitionByRange(*by, F.xxhash64("payload")).sortWithinPartitions(*by)
    typed.withColumn(DAY, F.lit(day)).write.mode("append").partitionBy(DAY).parquet(path)


def landed(spark: SparkSession, path: str, from_day: date | None = None) -> DataFrame:
    """A landed table, or its days from one on; other days are not listed."""
    rows = spark.read.parquet(path)
    return (rows if from_day is None else rows.where(F.col(DAY) >= F.lit(from_day))).drop(DAY)
