"""One collection to one table, schema taken on the first run and reused afterwards."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.plans.run import started, wants_full
from lakesync.plans.store import TableStore
from lakesync.plans.tables import stored_watermark, table_mode
from lakesync.schemas import TableSpec
from lakesync.sources.documents import (
    EXTRA, ID, document_schema, documents_type, kept_fields, probe, read_documents, read_schema, with_room)
from lakesync.sources.landing import DAY
from lakesync.sources.schema_days import day_schemas, whole_schema

SCHEMA_DAYS = TableSpec("document_schema_days", (("collection", "STRING"), ("day", "DATE"), ("found", "STRING")), key=("collection", "day"), order_by="day")


def first_schema(lines: DataFrame, string_fields: Sequence[str] = (), fields: Sequence[str] = (),
                 watermark_field: str | None = None, sample_size: int | None = None,
                 found: T.StructType | None = None) -> T.StructType:
    """Read schema of all documents, the watermark being a time whatever its spelling.

    With ``sample_size`` numbers get room for any other number and ``_extra``
    holds fields the sample did not show. ``found`` is the schema of all
    documents where it is known already.
    """
    kept = kept_fields(fields, string_fields, watermark_field)
    found = document_schema(lines, sample_size) if found is None else found
    schema = read_schema(with_room(found) if sample_size is not None else found, string_fields, kept)
    extra = [T.StructField(EXTRA, T.StringType())] if sample_size is not None and not kept else []
    return T.StructType([
        T.StructField(f.name, T.TimestampType() if f.name == watermark_field else f.dataType, True)
        for f in schema.fields] + extra)


def landed_schema(store: TableStore, lines: DataFrame, collection: str) -> T.StructType:
    """Schema of all landed days, kept in ``document_schema_days``: only days that are new there are parsed for it."""
    store.ensure_schema()
    store.ensure(SCHEMA_DAYS)
    known = store.read(SCHEMA_DAYS.name).where(F.col("collection") == collection).select("day", "found")
    found = day_schemas(lines, known).select(F.lit(collection).alias("collection"), "day", "found")
    store.upsert(SCHEMA_DAYS, found, unique=True)
    rows = store.read(SCHEMA_DAYS.name).where(F.col("collection") == collection).select("found").collect()  # a row a day
    return documents_type(whole_schema(r["found"] for r in rows))


def sync_documents(store: TableStore, lines: DataFrame, table: str, mode: str | None = None,
                   schema: T.StructType | None = None, string_fields: Sequence[str] = (),
                   fields: Sequence[str] = (), sample_size: int | None = None, watermark_field: str | None = None,
                   overlap_seconds: int = 300, now: datetime | None = None) -> dict[str, Any]:
    """First run: the whole collection. Later: documents whose watermark moved, merged on ``_id``.

    Without a watermark field every run reads everything. A full run takes the
    schema anew and replaces the table; it needs a document, a later run that
    finds none writes nothing. Lines that come with the day they landed have
    their schema kept by day.
    """
    full = wants_full(mode)
    store.ensure_schema()
    exists = store.exists(table)
    empty = probe(lines).isEmpty()
    if empty and (full or not exists):
        raise ValueError("the collection holds no document")
    since = None
    if exists and not full:
        schema = store.read(table).schema
        if watermark_field:
            since = stored_watermark(store, table, watermark_field)
    elif schema is None:
        by_day = DAY in lines.columns and sample_size is None
        schema = first_schema(lines, string_fields, fields, watermark_field, sample_size, landed_schema(store, lines, table) if by_day else None)
    until = started(now) if watermark_field else None
    columns = tuple((f.name, f.dataType.simpleString()) for f in schema.fields)
    spec = TableSpec(table, columns, key=(ID,), order_by=watermark_field or ID)
    if not empty:
        docs = read_documents(lines, schema, watermark_field, since, until, overlap_seconds)
        if full or not exists:
            store.replace_all(spec, docs, dedup=False)
        else:
            store.upsert(spec, docs)
    return {"table": store.name(table), "mode": table_mode(store, full, exists, since),
            "since": since.isoformat() if since else None, "rows_in_table": store.read(table).count()}
