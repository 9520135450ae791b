"""Queries that run the table store: what its writes leave behind and what they say they did."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.catalog import Tables, landed, query
from lakesync.mapping import crm, workspace
from lakesync.operators.dedup import newest
from lakesync.operators.quality import key_check
from lakesync.plans.crm import CrmLanding, sync_crm
from lakesync.plans.store import SEQ, TableStore, Written
from lakesync.schemas import BLOCKS, CONTACTS, TableSpec
from lakesync.session import Scratch
from lakesync.streaming.landing import upsert_stream
from lakesync.streaming.newest import newest_changes, write_changes

UTC = timezone.utc
ORDERS = TableSpec("orders_by_customer", (("customer", "BIGINT"), ("status", "STRING"), ("day", "TIMESTAMP"), ("number", "BIGINT")),
                   key=("customer", "status"), order_by="day")


def own_store(t: Tables, schema: str, buckets: int | None = 8) -> TableStore:
    """A store in a schema of its own, empty again at each call."""
    t.spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
    return TableStore(t.spark, schema, buckets=buckets)


def _orders(t: Tables) -> DataFrame:
    return t.only("orders", F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"),
                  F.col("o_orderdate").cast("timestamp").alias("day"), F.col("o_orderkey").alias("number"), F.col("o_orderkey").alias(SEQ))


def _facts(t: Tables, rows: list[tuple], ddl: str) -> DataFrame:
    return t.spark.createDataFrame(rows, ddl)


@query("table_lifecycle", """
    SELECT 'before' AS step, false AS there, 0 AS n_rows, 0 AS n_keys
    UNION ALL SELECT 'ensured', true, 0, 0 UNION ALL SELECT 'ensured again', true, 0, 0
    UNION ALL SELECT 'replaced', true, count(*), count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)
    UNION ALL SELECT 'kept by ensure', true, count(*), count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)
    UNION ALL SELECT 'emptied', true, 0, 0 UNION ALL SELECT 'dropped', false, 0, 0""")
def table_lifecycle(t: Tables):
    """Schema and table are made once, an overwrite keeps a row per key, one without rows empties the table."""
    store, steps = own_store(t, "lakesync_lifecycle"), []

    def look(step: str) -> None:
        there = store.exists(ORDERS.name)
        counts = key_check(store.read(ORDERS.name), ORDERS.key).first() if there else (0, 0)
        steps.append((step, there, counts[0], counts[1]))

    look("before")
    for step in ("ensured", "ensured again"):
        store.ensure_schema()
        store.ensure(ORDERS)
        look(step)
    store.replace_all(ORDERS, _orders(t))
    look("replaced")
    store.ensure(ORDERS)
    look("kept by ensure")
    store.replace_all(ORDERS, _orders(t).where("false"))
    look("emptied")
    store.drop(ORDERS.name)
    look("dropped")
    return _facts(t, steps, "step string, there boolean, n_rows long, n_keys long")


@query("table_overwrite", """
    SELECT customer, status, epoch_us(day) AS day, number FROM (
        SELECT o_custkey AS customer, o_orderstatus AS status, o_orderdate AS day, o_orderkey AS number,
               row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderpriority <> '5-LOW') WHERE rn = 1""")
def table_overwrite(t: Tables):
    """What the table held before is gone, whatever its age."""
    store = own_store(t, "lakesync_overwrite")
    store.ensure_schema()
    store.replace_all(ORDERS, _orders(t))
    kept = t.orders.where("o_orderpriority <> '5-LOW'").select(F.col("o_orderkey").alias("number"))
    store.replace_all(ORDERS, _orders(t).join(kept, "number", "left_semi"))
    return store.read(ORDERS.name)


def _contact_rows(t: Tables, version: str, read_at: datetime) -> DataFrame:
    rows = crm.object_rows(landed.contacts(t), "contacts", read_at)
    return rows.withColumn("last_name", F.concat("last_name", F.lit(version)))


@query("upsert_unchanged", """
    WITH n AS (SELECT count(*) AS n FROM customer), m AS (SELECT count(*) AS m FROM customer WHERE c_mktsegment = 'MACHINERY')
    SELECT 'first' AS run, n AS n_rows, n AS n_changed, true AS wrote FROM n
    UNION ALL SELECT 'same again', n, 0, false FROM n
    UNION ALL SELECT 'some edited', n, m, m > 0 FROM n, m
    UNION ALL SELECT 'same again, edited', n, 0, false FROM n""")
def upsert_unchanged(t: Tables):
    """Rows that a window reads again as they are stored touch no bucket, though they were read later."""
    store, runs, at = own_store(t, "lakesync_unchanged"), [], datetime(2024, 6, 1, tzinfo=UTC)
    store.ensure_schema()
    edited = _contact_rows(t, "", at).withColumn("last_name", F.when(F.col("lifecycle_stage") == "MACHINERY", F.concat("last_name", F.lit(" v2"))).otherwise(F.col("last_name")))
    for hour, (run, rows) in enumerate((("first", _contact_rows(t, "", at)), ("same again", _contact_rows(t, "", at)),
                                        ("some edited", edited), ("same again, edited", edited))):
        written = store.upsert(CONTACTS, rows.withColumn("_ingested_at", F.lit(at + timedelta(hours=hour))))
        runs.append((run, written.rows, written.changed, written.touched > 0))
    return _facts(t, runs, "run string, n_rows long, n_changed long, wrote boolean")


@query("staging_count", """
    SELECT o_orderpriority AS delta, count(*) AS n_rows, count(DISTINCT (o_custkey, o_orderstatus)) AS n_keys, epoch_us(max(o_orderdate)) AS newest
    FROM orders GROUP BY 1 UNION ALL SELECT 'none', 0, 0, NULL""")
def staging_count(t: Tables):
    """Rows staged by each delta, copies included, and their newest time; counted while they are written."""
    store, runs = own_store(t, "lakesync_staging"), []
    store.ensure_schema()
    rows = t.only("orders", "o_orderpriority", F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"),
                  F.col("o_orderdate").cast("timestamp").alias("day"), F.col("o_orderkey").alias("number"), F.col("o_orderkey").alias(SEQ))
    deltas = [r[0] for r in rows.select("o_orderpriority").distinct().collect()]
    for delta in [*sorted(deltas), "none"]:
        store.ensure(ORDERS)
        store.replace_all(ORDERS, _orders(t).where("false"))  # each delta alone, so what changes is a row per key
        written: Written = store.upsert(ORDERS, rows.where(F.col("o_orderpriority") == delta).drop("o_orderpriority"))
        runs.append((delta, written.rows, written.changed, written.newest))
    return _facts(t, runs, "delta string, n_rows long, n_keys long, newest timestamp")


@query("blocks_changed", """
    WITH listed AS (SELECT CAST(conv_id AS VARCHAR) AS page_id, conv_id || '-' || turn AS id, role, turn, conv_id FROM conversations)
    SELECT page_id, id, role AS type, CAST(CASE WHEN conv_id % 3 = 0 THEN turn + 10 ELSE turn END AS INTEGER) AS position
    FROM listed WHERE conv_id % 3 <> 1 OR turn > 0""")
def blocks_changed(t: Tables):
    """All pages walked again: those whose blocks moved or went are written, the others left as they are; as if all were replaced."""
    store = own_store(t, "lakesync_blocks", buckets=32)
    store.ensure_schema()
    blocks = landed.blocks(t)
    store.replace_all(BLOCKS, workspace.block_rows(blocks, datetime(2024, 6, 1, tzinfo=UTC)))
    page = F.col("page_id").cast("bigint")
    walked = blocks.where((page % 3 != 1) | (F.col("turn") > 0)).withColumn("position", F.when(page % 3 == 0, F.col("position") + 10).otherwise(F.col("position")))
    store.replace_by_parent(BLOCKS, workspace.block_rows(walked, datetime(2024, 6, 2, tzinfo=UTC)), blocks.select("page_id").distinct())
    return store.read(BLOCKS.name).select("page_id", "id", "type", "position")


@query("pages_touched", f"""
    SELECT run, n_rows, wrote FROM (SELECT 'same again' AS run, count(*) AS n_rows, false AS wrote FROM conversations
    UNION ALL SELECT 'one page', count(*), true FROM conversations)""")
def pages_touched(t: Tables):
    store, runs = own_store(t, "lakesync_pages"), []
    store.ensure_schema()
    blocks = landed.blocks(t)
    pages = blocks.select("page_id").distinct()
    store.replace_all(BLOCKS, workspace.block_rows(blocks, datetime(2024, 6, 1, tzinfo=UTC)))
    moved = blocks.withColumn("position", F.when(F.col("page_id") == "0", F.col("position") + 10).otherwise(F.col("position")))
    for run, walked, most in (("same again", blocks, 0), ("one page", moved, 1)):
        written = store.replace_by_parent(BLOCKS, workspace.block_rows(walked, datetime(2024, 6, 2, tzinfo=UTC)), pages)
        if written.touched > most:
            raise AssertionError(f"{written.touched} buckets written")
        runs.append((run, written.rows, written.touched > 0))
    return _facts(t, runs, "run string, n_rows long, wrote boolean")


@query("job_isolation", """
    SELECT 'contacts' AS object, 'SUCCESS' AS status, count(*) AS rows, count(*) AS stored, false AS failed FROM customer
    UNION ALL SELECT 'companies', 'FAILED', 0, 0, true
    UNION ALL SELECT 'deals', 'SUCCESS', count(*), count(*), false FROM orders""")
def job_isolation(t: Tables):
    """One object's answers hold an error: it fails and writes nothing, the others are written."""
    store = own_store(t, "lakesync_isolation")
    records = {"contacts": landed.contacts(t), "companies": landed.companies(t), "deals": landed.deals(t)}
    answers = landed.land(t.supplier, landed.json_object(errors=F.array(F.struct(F.lit("VALIDATION_ERROR").alias("category")))))
    report = sync_crm(store, CrmLanding(records, answers={"companies": answers}), objects=list(records), now=landed.RUN_AT)
    stored = _facts(t, [(name, store.read(name).count() if store.exists(name) else 0) for name in records], "object string, stored long")
    return report.join(stored, "object").select("object", "status", "rows", "stored", F.col("error").isNotNull().alias("failed"))


def _event_files(t: Tables, scratch: Scratch, numbers: list[int]) -> None:
    """Land some thirds of the events, the later ones first and some rows twice, one file at a time."""
    events = t.events.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value", "event_id")
    third = F.pmod("event_id", F.lit(3))
    for number in numbers:
        some = events.where((third == 2 - number) | ((third == 2) & (F.lit(number) == 2)))
        some.coalesce(1).write.mode("append").parquet(f"{scratch.root}/landing")


EVENTS = TableSpec("events_by_user", (("user_id", "BIGINT"), ("event_type", "STRING"), ("ts", "TIMESTAMP"), ("value", "DOUBLE"), ("event_id", "BIGINT")),
                   key=("user_id", "event_type"), order_by="ts")


def _events_landing(t: Tables, scratch: Scratch) -> DataFrame:
    return t.spark.readStream.schema(EVENTS.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch.root}/landing")


def _run_stream(t: Tables, store: TableStore, scratch: Scratch) -> int:
    stream = _events_landing(t, scratch)
    running = upsert_stream(stream, lambda batch: batch.withColumn(SEQ, F.col("event_id")), store, EVENTS, f"{scratch.root}/progress")
    running.awaitTermination()
    return sum(progress["numInputRows"] for progress in running.recentProgress)


_STREAM_SQL = """
    WITH files AS (SELECT *, CASE WHEN event_id % 3 = 2 THEN 2 ELSE 2 - event_id % 3 END AS file FROM events)
    SELECT user_id, event_type, epoch_us(ts) AS ts, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY file DESC, ts DESC, event_id DESC) AS rn FROM files) WHERE rn = 1"""


@query("stream_late", _STREAM_SQL)
def stream_late(t: Tables):
    """Rows that land late or again: the file that landed last decides, no row is dropped for its age."""
    store, scratch = own_store(t, "lakesync_late"), Scratch(t.spark)
    _event_files(t, scratch, [0, 1, 2])
    _run_stream(t, store, scratch)
    scratch.drop_all()
    return store.read(EVENTS.name).drop("event_id")


@query("stream_restart", """
    SELECT 'first' AS run, count(*) AS n_read FROM events WHERE event_id % 3 = 2
    UNION ALL SELECT 'nothing new', 0
    UNION ALL SELECT 'two more files', count(*) FROM (SELECT * FROM events WHERE event_id % 3 = 1 UNION ALL SELECT * FROM events WHERE event_id % 3 IN (0, 2))""")
def stream_restart(t: Tables):
    """Progress is kept with the written batches: a file is read once, over all runs of the stream."""
    store, scratch, runs = own_store(t, "lakesync_restart"), Scratch(t.spark), []
    for run, files in (("first", [0]), ("nothing new", []), ("two more files", [1, 2])):
        _event_files(t, scratch, files)
        runs.append((run, _run_stream(t, store, scratch)))
    scratch.drop_all()
    return _facts(t, runs, "run string, n_read long")


@query("stream_changes", """
    WITH landed AS (SELECT *, 2 - event_id % 3 AS file FROM events UNION ALL SELECT *, 2 FROM events WHERE event_id % 3 = 2),
    best AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, file ORDER BY ts DESC, event_id DESC) AS rn FROM landed),
    firsts AS (SELECT *, max((ts, event_id)) OVER (PARTITION BY user_id, event_type ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known
               FROM best WHERE rn = 1),
    changes AS (SELECT * FROM firsts WHERE known IS NULL OR (ts, event_id) > known)
    SELECT user_id, event_type, epoch_us(max(ts)) AS ts, max_by(value, (ts, event_id)) AS value, count(*) AS n_changes FROM changes GROUP BY ALL""")
def stream_changes(t: Tables):
    """The newest row per key of files that land late and again, from what a stream with keyed state wrote over two runs."""
    scratch = Scratch(t.spark)
    for files in ([0], [1, 2]):
        _event_files(t, scratch, files)
        changes = newest_changes(_events_landing(t, scratch), EVENTS.key, EVENTS.order_by, "event_id")
        write_changes(changes, f"{scratch.root}/changes", f"{scratch.root}/progress").awaitTermination()
    log = t.spark.read.schema(EVENTS.schema).parquet(f"{scratch.root}/changes")
    counted = log.groupBy(*EVENTS.key).agg(F.count(F.lit(1)).alias("n_changes"))
    return newest(log, EVENTS.key, EVENTS.order_by, ["event_id"]).drop("event_id").join(counted, list(EVENTS.key))
