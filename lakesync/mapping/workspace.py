"""Workspace records: pages, data sources, blocks and users."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.functions.payload import (
    RECORD, canonical, first_title, node_at, plain_text, string_only, text_at, truthy, with_record,
)
from lakesync.functions.times import parse_iso
from lakesync.operators.windows import instant
from lakesync.schemas import BLOCKS, DATA_SOURCES, PAGES, USERS, TableSpec


def in_trash(record: Column) -> Column:
    """``in_trash`` when the key is there (even as null), else the older ``archived``."""
    return truthy(F.coalesce(node_at(record, "in_trash"), node_at(record, "archived")))


def parent_of(record: Column) -> tuple[Column, Column]:
    """Parent type, and the id stored under that type's name; a non-text value is no id."""
    kind = text_at(record, "parent.type")
    return kind, F.when(kind != "", string_only(record, F.concat(F.lit("$.parent['"), kind, F.lit("']"))))


def _common(record: Column) -> dict[str, Column]:
    parent_type, parent_id = parent_of(record)
    return {
        "id": text_at(record, "id"),
        "created_time": parse_iso(text_at(record, "created_time"), "created_time"),
        "last_edited_time": parse_iso(text_at(record, "last_edited_time"), "last_edited_time"),
        "created_by_id": text_at(record, "created_by.id"),
        "last_edited_by_id": text_at(record, "last_edited_by.id"),
        "in_trash": in_trash(record),
        "parent_type": parent_type,
        "parent_id": parent_id,
    }


def _rows(records: DataFrame, spec: TableSpec, columns: dict[str, Column], run_at: datetime,
          keep: Sequence[str]) -> DataFrame:
    columns = columns | {"raw_json": canonical(F.col(RECORD)), "_ingested_at": instant(run_at)}
    return with_record(records).select(*[columns[name].alias(name) for name in spec.names], *keep)


def page_rows(records: DataFrame, run_at: datetime, keep: Sequence[str] = ()) -> DataFrame:
    record = F.col(RECORD)
    columns = _common(record) | {
        "url": text_at(record, "url"),
        "public_url": text_at(record, "public_url"),
        "title": first_title(F.col("payload")),
    }
    return _rows(records, PAGES, columns, run_at, keep)


def data_source_rows(records: DataFrame, run_at: datetime, keep: Sequence[str] = ()) -> DataFrame:
    record = F.col(RECORD)
    parts = F.from_json("payload", "title array<struct<plain_text:string>>")["title"]
    columns = _common(record) | {
        "url": text_at(record, "url"),
        "title": F.when(parts.isNotNull(), plain_text(parts)),
    }
    return _rows(records, DATA_SOURCES, columns, run_at, keep)


def block_rows(records: DataFrame, run_at: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Blocks with the ``page_id``, ``depth`` and ``position`` columns of the tree walk."""
    record = F.col(RECORD)
    columns = _common(record) | {
        "type": text_at(record, "type"),
        "has_children": truthy(node_at(record, "has_children")),
        "page_id": F.col("page_id").cast("string"),
        "depth": F.col("depth").cast("int"),
        "position": F.col("position").cast("int"),
    }
    return _rows(records, BLOCKS, columns, run_at, keep)


def user_rows(records: DataFrame, run_at: datetime, keep: Sequence[str] = ()) -> DataFrame:
    record = F.col(RECORD)
    columns = {name: text_at(record, name) for name in ("id", "type", "name", "avatar_url")}
    columns["email"] = text_at(record, "person.email")
    return _rows(records, USERS, columns, run_at, keep)
