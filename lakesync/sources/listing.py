"""Landed listing pages and records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.functions.payload import each, once
from lakesync.functions.times import to_time
from lakesync.operators.windows import open_ended
from lakesync.sources.landing import typed_objects


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """One ``payload`` per line of the landed JSON files, with the file it came from."""
    return spark.read.text(path).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source"))


def listing_items(pages: DataFrame, field: str = "results", keep: Sequence[str] = ()) -> DataFrame:
    """The items of every page: one ``payload`` each, ``item`` being its place on the page."""
    items = F.from_json("payload", f"{field} array<string>")[field]
    return each(pages, items, keep, item="payload", place="item")


def _flag(payload: str = "payload") -> Column:
    # read as a JSON boolean: the text "true" does not count
    return F.coalesce(F.from_json(payload, "archived boolean")["archived"], F.lit(False))


def live(records: DataFrame) -> DataFrame:
    return records.filter(~_flag())


def archived(records: DataFrame) -> DataFrame:
    return records.filter(_flag())


def archived_ids(records: DataFrame) -> DataFrame:
    """``(id, archived_at)`` of every archived record."""
    spelled = once(archived(records), id=F.get_json_object("payload", "$.id"),
                   _at=F.get_json_object("payload", "$.archivedAt"))
    return spelled.select("id", to_time(F.col("_at")).alias("archived_at"))


def property_names(records: DataFrame) -> DataFrame:
    """Names of all properties any record carries."""
    names = F.json_object_keys(F.get_json_object("payload", "$.properties"))
    return each(records, names, item="name").distinct()


def read_by_ids(records: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Full records of the listed ids; ids without a record are passed over."""
    return records.join(ids.select(key).distinct(), key, "left_semi")


def missing_ids(records: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Listed ids that have no record."""
    return ids.select(key).distinct().join(records.select(key), key, "left_anti")


def live_ids(table: DataFrame) -> DataFrame:
    """Ids of rows known not to be archived; an unknown flag does not count."""
    return table.filter("NOT archived").select("id")


def changes_since(objects: DataFrame, kind: str, since: datetime | None = None, overlap_seconds: int = 0) -> DataFrame:
    """Landed objects of one type edited since the watermark; partial ones (no edit time) are left out.

    Adds ``edited``. Typed landings are narrowed before any payload is parsed.
    """
    typed = typed_objects(objects)
    return open_ended(typed.where(F.col("kind") == kind).drop("kind"), "edited", since, overlap_seconds)
