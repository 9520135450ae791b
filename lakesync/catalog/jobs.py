"""Whole jobs as one DataFrame each: the table a run leaves behind."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from lakesync.catalog import Tables, landed, query
from lakesync.catalog.mapped import CHANGED, WORKSPACE_PAGE, contact_sql, issue_sql
from lakesync.mapping import crm, workspace
from lakesync.operators import apply
from lakesync.plans.crm import record_change
from lakesync.plans.documents import first_schema
from lakesync.plans.issues import issue_change
from lakesync.plans.run import applied
from lakesync.plans.store import SEQ, TableStore
from lakesync.plans.workspace import WorkspaceLanding, block_change, object_change, page_refs
from lakesync.schemas import PAGES, TableSpec
from lakesync.session import remove, shared_folder
from lakesync.sources.documents import read_documents
from lakesync.sources.listing import archived, changes_since, live
from lakesync.streaming.landing import upsert_stream

UTC = timezone.utc
SINCE = datetime(2024, 1, 1, 6, tzinfo=UTC)
UNTIL = datetime(2024, 1, 1, 20, tzinfo=UTC)


@query("sync_full", f"SELECT {contact_sql()} FROM customer")
def sync_full(t: Tables):
    records = landed.contacts(t)
    # every archived record was landed by both listings
    landed_rows = live(records).unionByName(archived(records)).unionByName(archived(records))
    return applied(None, record_change(landed_rows, "contacts", None, landed.RUN_AT)).drop("raw_json")


@query("sync_incremental", f"""
    WITH c AS (SELECT *, {CHANGED.format(key="c_custkey")} AS changed FROM customer),
    read AS (SELECT * FROM c WHERE c_acctbal >= 0 AND changed >= epoch_us(TIMESTAMP '2024-01-01 05:55:00')
                                   AND changed < epoch_us(TIMESTAMP '2024-01-01 20:00:00')),
    marks AS (SELECT c_custkey AS id, changed AS marked FROM c WHERE c_acctbal < 0
        UNION ALL SELECT c_custkey + n, epoch_us(TIMESTAMP '2024-01-01 20:00:00')
        FROM read, (VALUES (1), (2)) v(n) WHERE c_mktsegment = 'MACHINERY'),
    latest AS (SELECT id, max(marked) AS marked FROM marks GROUP BY id)
    SELECT CAST(c.c_custkey AS VARCHAR) AS id, c.changed AS updated_at,
           c.c_name || CASE WHEN r.c_custkey IS NULL THEN '' ELSE ' v2' END AS last_name,
           l.id IS NOT NULL AS archived, l.marked AS archived_at
    FROM c LEFT JOIN read r ON c.c_custkey = r.c_custkey LEFT JOIN latest l ON c.c_custkey = l.id""")
def sync_incremental(t: Tables):
    target = crm.object_rows(landed.contacts(t), "contacts", SINCE)
    change = record_change(landed.contacts(t, edited=True, typed=True), "contacts", SINCE, UNTIL)
    return applied(target, change).select("id", "updated_at", "last_name", "archived", "archived_at")


@query("sync_notionlike", f"""
    SELECT CASE WHEN last_edited_time >= epoch_us(TIMESTAMP '2024-01-01 05:55:00') THEN v2.title ELSE v1.title END AS title,
           id, v1.last_edited_time, v1.in_trash
    FROM ({WORKSPACE_PAGE.format(suffix="")}) v1 JOIN
         (SELECT id, title FROM ({WORKSPACE_PAGE.format(suffix=" v2")})) v2 USING (id)
    WHERE v1.last_edited_time IS NOT NULL""")
def sync_notionlike(t: Tables):
    target = workspace.page_rows(changes_since(landed.pages(t, typed=True), "page"), SINCE)
    changed = changes_since(landed.pages(t, edited=True, typed=True), "page", SINCE, 300)
    return applied(target, object_change(PAGES, workspace.page_rows, changed, UNTIL, whole=False)).select(
        "id", "title", "last_edited_time", "in_trash")


@query("sync_issue", f"""
    SELECT * FROM (
        SELECT {issue_sql()} FROM orders LEFT JOIN customer ON o_custkey = c_custkey) WHERE updated
            < epoch_us(TIMESTAMP '1999-12-31 23:55:00')
    UNION ALL SELECT * FROM (
        SELECT {issue_sql(" v2")} FROM orders LEFT JOIN customer ON o_custkey = c_custkey) WHERE updated
            BETWEEN epoch_us(TIMESTAMP '1999-12-31 23:55:00') AND epoch_us(TIMESTAMP '2001-06-01 12:30:00')""")
def sync_issue(t: Tables):
    since, until = datetime(2000, 1, 1, tzinfo=UTC), datetime(2001, 6, 1, 12, 30, 59, tzinfo=UTC)
    target = applied(None, issue_change(landed.issues(t, typed=True), None, since, whole=True))
    return applied(target, issue_change(landed.issues(t, edited=True, typed=True), since, until, whole=False))


@query("sync_blocks", """
    WITH RECURSIVE ends AS (SELECT conv_id, max(turn) AS top,
            make_timestamp(1704067200000000 + (conv_id % 525600) * 60000000) AS edited
        FROM conversations GROUP BY conv_id),
    changed AS (SELECT * FROM ends WHERE edited >= TIMESTAMP '2024-01-01 00:25:00'),
    listed AS (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' AND turn > 0 THEN conv_id || '-' || (turn - 1)
                      ELSE CAST(conv_id AS VARCHAR) END AS parent FROM conversations),
    placed AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY turn) - 1 AS position FROM listed),
    walk AS (
        SELECT conv_id, turn, role, 0 AS depth, position FROM placed WHERE parent = CAST(conv_id AS VARCHAR)
        UNION ALL SELECT p.conv_id, p.turn, p.role, w.depth + 1, p.position
        FROM walk w JOIN placed p ON p.parent = w.conv_id || '-' || w.turn)
    SELECT CAST(conv_id AS VARCHAR) AS page_id, conv_id || '-' || turn AS id, role AS type, depth, position FROM walk
    WHERE conv_id IN (SELECT conv_id FROM changed WHERE top > 0 AND top < 7)
    UNION ALL SELECT CAST(conv_id AS VARCHAR), conv_id || '-' || turn, role, 0, CAST(turn AS BIGINT) FROM conversations
    WHERE conv_id NOT IN (SELECT conv_id FROM changed)""")
def sync_blocks(t: Tables):
    ends = t.conversations.groupBy("conv_id").agg(F.max("turn").alias("top"))
    # pages of eight turns are in the trash, those of a single turn cannot be read
    pages = landed.land(ends, landed.json_object(
        object=F.lit("page"), id=landed.text("conv_id"), in_trash=F.col("top") >= 7,
        last_edited_time=landed.iso(landed.minutes_after_base("conv_id"))))
    unreadable = ends.filter("top = 0").select(landed.text("conv_id").alias("page_id"))
    # answers are listed below the turn they answer
    turns = landed.blocks(t, has_children=True)
    nested = (F.col("role") == "assistant") & (F.col("turn") > 0)
    children = turns.select(
        F.when(nested, F.concat_ws("-", "conv_id", F.col("turn") - 1)).otherwise(landed.text("conv_id")).alias("parent_id"),
        F.col("turn").alias("seq"), "payload")
    stored = workspace.block_rows(landed.blocks(t), SINCE)
    refs = page_refs(changes_since(pages, "page", datetime(2024, 1, 1, 0, 30, tzinfo=UTC), 300))
    change = block_change(refs, WorkspaceLanding(children=children, unreadable=unreadable, listed=pages.select(
        F.get_json_object("payload", "$.id").alias("parent_id"))), UNTIL, whole=False)
    return applied(stored, change).select("page_id", "id", "type", "depth", "position")


@query("stream_upsert", """
    SELECT user_id, event_type, epoch_us(ts) AS ts, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""")
def stream_upsert(t: Tables):
    columns = (("user_id", "BIGINT"), ("event_type", "STRING"), ("ts", "TIMESTAMP"), ("value", "DOUBLE"), ("event_id", "BIGINT"))
    spec = TableSpec("stream_upsert", columns, key=("user_id", "event_type"), order_by="ts")
    run = uuid.uuid4().hex[:8]
    store = TableStore(t.spark, "lakesync_stream", buckets=8, run_id=run)
    t.spark.sql("DROP SCHEMA IF EXISTS lakesync_stream CASCADE")  # what the call before this one returned
    events = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events*.parquet")
    fields = {name: F.col(name) for name, _ in columns}
    fields["ts"] = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    payloads = events.select(landed.json_object(**fields).alias("payload"))

    def rows(batch):
        typed = batch.select(F.from_json("payload", spec.ddl).alias("e")).select("e.*")
        return typed.withColumn(SEQ, F.col("event_id"))

    progress = f"{shared_folder(t.spark)}/stream-{run}"
    upsert_stream(payloads, rows, store, spec, progress).awaitTermination()
    remove(t.spark, progress)
    return store.read(spec.name).drop("event_id")


@query("sync_document", """
    SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER)) AS _id, epoch_us(l_shipdate) AS shipped,
           CAST(l_linenumber AS BIGINT) AS number,
           CASE WHEN l_shipdate >= TIMESTAMP '1999-12-31 23:55:00' THEN 2 ELSE 1 END AS batch
    FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' OR l_shipdate <= TIMESTAMP '2001-06-01'""")
def sync_document(t: Tables):
    since, until = datetime(2000, 1, 1, tzinfo=UTC), datetime(2001, 6, 1, tzinfo=UTC)
    lines = landed.documents(t)
    schema = first_schema(lines, watermark_field="shipped")
    first = read_documents(lines.filter("l_shipdate < TIMESTAMP_NTZ '2000-01-01'"), schema, "shipped")
    changed = read_documents(lines, schema, "shipped", since, until)
    columns = ["_id", "shipped", F.col("line.number").alias("number")]
    return apply.upsert(first.select(*columns, F.lit(1).alias("batch")), changed.select(*columns, F.lit(2).alias("batch")),
                        ["_id"], "shipped")
