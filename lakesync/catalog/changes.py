"""Delta application, newest-row selection, windows, state and checks."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.catalog import Tables, landed, query
from lakesync.mapping.crm import merged_away
from lakesync.operators import apply, quality, state, tree, windows
from lakesync.operators.dedup import newest, newest_counted
from lakesync.operators.ranking import keyset_chunks
from lakesync.plans.workspace import page_refs, readable_pages, skipped_pages
from lakesync.sources.listing import changes_since

LINE_KEY = ["l_orderkey", "l_linenumber"]
# every other number of the row, so that equal dates still have one winner
LINE_TIE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
CHECKPOINT = datetime(2024, 1, 15, 12, 0, 30, 500_000, tzinfo=timezone.utc)
RUN_START = datetime(2024, 1, 20, 6, 30, 45, 250_000, tzinfo=timezone.utc)
PAGES_SINCE = datetime(2024, 1, 20, tzinfo=timezone.utc)
BLOCKS_SINCE = datetime(2024, 1, 10, tzinfo=timezone.utc)

_ORDERS = ("o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice, "
           "epoch_us(o_orderdate) AS o_orderdate, o_orderpriority")
_LINES = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
          "l_returnflag, l_linestatus, epoch_us(l_shipdate) AS l_shipdate")
_LINE_RANK = ("row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, "
              "l_suppkey DESC, l_quantity DESC, l_extendedprice DESC)")


@query("merge_upsert", f"""
    SELECT {_ORDERS.format(price="o_totalprice")} FROM orders WHERE o_orderdate < TIMESTAMP '1997-12-01'
    UNION ALL
    SELECT {_ORDERS.format(price="o_totalprice * 2")} FROM orders WHERE o_orderdate >= TIMESTAMP '1997-12-01'""")
def merge_upsert(t: Tables):
    target = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01'")
    delta = (t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1997-12-01'")
             .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return apply.upsert(target, delta, ["o_orderkey"], "o_orderdate", ["o_totalprice"])


@query("merge_composite", f"""
    WITH ranked AS (SELECT *, {_LINE_RANK.replace("l_linenumber ORDER", "l_linenumber, l_returnflag = 'N' ORDER")} AS rn
                    FROM lineitem),
         delta AS (SELECT * FROM ranked WHERE l_returnflag = 'N' AND rn = 1),
         target AS (SELECT * FROM ranked WHERE l_returnflag <> 'N' AND rn = 1)
    SELECT {_LINES} FROM target WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM delta)
    UNION ALL SELECT {_LINES} FROM delta""")
def merge_composite(t: Tables):
    target = newest(t.lineitem.filter("l_returnflag <> 'N'"), LINE_KEY, "l_shipdate", LINE_TIE)
    return apply.upsert(target, t.lineitem.filter("l_returnflag = 'N'"), LINE_KEY, "l_shipdate", LINE_TIE)


@query("flag_archived", f"""
    WITH marks AS (
        SELECT o_custkey AS id, o_orderdate AS marked FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT c_custkey + 1, TIMESTAMP '2024-06-01' FROM customer WHERE c_mktsegment = 'MACHINERY'
        UNION ALL SELECT c_custkey + 2, TIMESTAMP '2024-06-01' FROM customer WHERE c_mktsegment = 'MACHINERY'),
    latest AS (SELECT id, max(marked) AS marked FROM marks GROUP BY id)
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
           latest.id IS NOT NULL OR c_acctbal < 0 AS archived,
           epoch_us(CASE WHEN latest.id IS NOT NULL THEN latest.marked END) AS archived_at
    FROM customer LEFT JOIN latest ON c_custkey = latest.id""")
def flag_archived(t: Tables):
    target = t.customer.select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        (F.col("c_acctbal") < 0).alias("archived"), F.lit(None).cast("timestamp").alias("archived_at"))
    archived = t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").cast("string").alias("id"), F.col("o_orderdate").cast("timestamp").alias("archived_at"))
    merged = merged_away(landed.contacts(t)).withColumn("archived_at", windows.instant(landed.RUN_AT))
    return apply.flag_archived(target, archived.unionByName(merged))


@query("replace_by_parent", """
    WITH led AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'system'),
         long AS (SELECT DISTINCT conv_id FROM conversations WHERE turn >= 5)
    SELECT conv_id, turn, role, text FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM led)
    UNION ALL
    SELECT conv_id, turn, role, 'edited: ' || text FROM conversations
    WHERE conv_id IN (SELECT conv_id FROM led) AND conv_id NOT IN (SELECT conv_id FROM long) AND turn < 3""")
def replace_by_parent(t: Tables):
    # conversations opened by the system changed; the long ones among them were thrown away
    changed = t.conversations.filter("role = 'system'").select("conv_id").distinct()
    trashed = t.conversations.filter("turn >= 5").select("conv_id").distinct()
    kept = changed.join(trashed, "conv_id", "left_anti")
    staged = (t.conversations.filter("turn < 3").join(kept, "conv_id", "left_semi")
              .withColumn("text", F.concat(F.lit("edited: "), "text")))
    return apply.replace_by_parent(t.conversations, staged, changed, "conv_id", ["conv_id", "turn"], "turn", ["text"])


@query("overwrite_dedup", f"SELECT {_LINES} FROM (SELECT *, {_LINE_RANK} AS rn FROM lineitem) WHERE rn = 1")
def overwrite_dedup(t: Tables):
    return apply.overwrite(t.lineitem, LINE_KEY, "l_shipdate", LINE_TIE)


@query("dedup_newest", """
    SELECT user_id, event_type, event_id, epoch_us(ts) AS ts FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""")
def dedup_newest(t: Tables):
    return newest(t.events, ["user_id", "event_type"], "ts", ["event_id"]).select("user_id", "event_type", "event_id", "ts")


@query("dedup_newest_ties", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_us(updated) AS updated FROM (
        SELECT *, CASE WHEN l_linestatus <> 'F' THEN l_shipdate END AS updated,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY CASE WHEN l_linestatus <> 'F' THEN l_shipdate END DESC NULLS LAST,
                            l_partkey * 10000000000 + l_suppkey DESC) AS rn
        FROM lineitem) WHERE rn = 1""")
def dedup_newest_ties(t: Tables):
    lines = (t.lineitem.withColumn("updated", F.when(F.col("l_linestatus") != "F", F.col("l_shipdate")))
             .withColumn("seq", F.col("l_partkey") * 10_000_000_000 + F.col("l_suppkey")))
    return newest(lines, LINE_KEY, "updated", ["seq"]).select(*LINE_KEY, "l_partkey", "l_suppkey", "updated")


@query("staged_counts", """
    SELECT l_returnflag, count(*) AS staged, count(DISTINCT (l_orderkey, l_linenumber)) AS in_table
    FROM lineitem GROUP BY l_returnflag""")
def staged_counts(t: Tables):
    # the counting of a whole-table write: every row kept says how many copies its key had
    rows = t.lineitem.select("l_returnflag", *LINE_KEY, "l_shipdate")
    kept = newest_counted(rows, ["l_returnflag", *LINE_KEY], "l_shipdate")
    return kept.groupBy("l_returnflag").agg(F.sum("_copies").alias("staged"), F.count(F.lit(1)).alias("in_table"))


# ---- windows ---------------------------------------------------------------------

_EVENTS = "SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value FROM events WHERE "


def _events(df):
    return df.select("event_id", "ts", "user_id", "event_type", "value")


@query("window_closed", _EVENTS + "ts BETWEEN TIMESTAMP '2024-01-15 11:55:30.5' AND TIMESTAMP '2024-01-20 06:30:45.25'")
def window_closed(t: Tables):
    return _events(windows.closed(t.events, "ts", CHECKPOINT, RUN_START))


@query("window_half_open", _EVENTS + "ts >= TIMESTAMP '2024-01-15 11:55:30.5' AND ts < TIMESTAMP '2024-01-20 06:30:45.25'")
def window_half_open(t: Tables):
    return _events(windows.half_open(t.events, "ts", CHECKPOINT, RUN_START))


@query("window_minute", _EVENTS + """ts >= date_trunc('minute', TIMESTAMP '2024-01-15 11:55:30.5')
    AND ts <= date_trunc('minute', TIMESTAMP '2024-01-20 06:30:45.25') AND event_type <> 'view'""")
def window_minute(t: Tables):
    return _events(windows.by_minute(t.events.filter("event_type <> 'view'"), "ts", CHECKPOINT, RUN_START))


@query("window_first_run", """
    SELECT 'closed' AS kind, count(*) AS n FROM events
    UNION ALL SELECT 'minute', count(*) FROM events WHERE ts <= TIMESTAMP '2024-01-20 06:30:00'""")
def window_first_run(t: Tables):
    def counted(kind, df):
        return df.select(F.lit(kind).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))

    return counted("closed", windows.closed(t.events, "ts", None, RUN_START)).unionByName(
        counted("minute", windows.by_minute(t.events, "ts", None, RUN_START)))


@query("changes_since", """
    SELECT 'p' || doc_id AS id, epoch_us(edited) AS edited, source = 'src1' OR source = 'src2' AS in_trash
    FROM (SELECT *, make_timestamp(1704067200000000 + (doc_id % 525600) * 60000000) AS edited FROM documents)
    WHERE source <> 'src7' AND edited >= TIMESTAMP '2024-01-01 02:55:00' ORDER BY edited DESC""")
def change_feed(t: Tables):
    since = datetime(2024, 1, 1, 3, tzinfo=timezone.utc)
    return page_refs(changes_since(landed.pages(t), "page", since, 300)).orderBy(F.desc("edited"))


# ---- aggregates and state -----------------------------------------------------------

@query("watermark_max", """
    SELECT event_type, epoch_us(max(ts)) AS watermark FROM events GROUP BY event_type
    UNION ALL SELECT 'nothing', epoch_us(max(ts)) FROM events WHERE event_type IS NULL""")
def watermark_max(t: Tables):
    nothing = t.events.filter("event_type IS NULL")
    per_type = t.events.groupBy("event_type").agg(state.watermark("ts").alias("watermark"))
    return per_type.unionByName(nothing.agg(state.watermark("ts").alias("watermark"))
                                .select(F.lit("nothing").alias("event_type"), "watermark"))


@query("newest_or_old", """
    SELECT event_type, epoch_us(coalesce(max(ts) FILTER (ts >= TIMESTAMP '2024-01-20' AND event_type <> 'signup'),
                                         max(ts) FILTER (ts < TIMESTAMP '2024-01-20'))) AS watermark
    FROM events GROUP BY event_type""")
def newest_or_old(t: Tables):
    stored = (t.events.filter("ts < TIMESTAMP_NTZ '2024-01-20'").groupBy("event_type")
              .agg(F.max("ts").alias("stored")))
    run = (windows.open_ended(t.events, "ts", PAGES_SINCE).filter("event_type <> 'signup'")
           .groupBy("event_type").agg(F.max("ts").alias("newest")))
    return stored.join(run, "event_type", "left").select(
        "event_type", state.newest_or_kept(F.col("newest"), F.col("stored")).alias("watermark"))


@query("shared_discovery", """
    WITH refs AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                  FROM events WHERE ts >= TIMESTAMP '2024-01-10')
    SELECT event_type, count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS pages,
           count(*) FILTER (ts >= TIMESTAMP '2024-01-10') AS blocks, epoch_us(max(ts)) AS newest,
           epoch_us(TIMESTAMP '2024-01-10') AS threshold
    FROM refs WHERE rn = 1 GROUP BY event_type""")
def shared_discovery(t: Tables):
    # one scan back to the earlier threshold serves both objects
    lowest = min(PAGES_SINCE, BLOCKS_SINCE)
    refs = newest(windows.open_ended(t.events, "ts", lowest), ["user_id"], "ts", ["event_id"])
    edited = F.col("ts").cast("timestamp")
    return refs.groupBy("event_type").agg(
        F.count_if(edited >= windows.instant(PAGES_SINCE)).alias("pages"),
        F.count_if(edited >= windows.instant(BLOCKS_SINCE)).alias("blocks"),
        F.max("ts").alias("newest")).withColumn("threshold", windows.instant(lowest))


@query("shared_threshold", """
    SELECT l_returnflag, CASE WHEN count(*) FILTER (l_linestatus = 'F' AND l_returnflag = 'A') = 0
                              THEN epoch_us(min(l_shipdate)) END AS threshold
    FROM lineitem GROUP BY l_returnflag""")
def shared_threshold(t: Tables):
    bound = F.when(~((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A")), F.col("l_shipdate"))
    return t.lineitem.groupBy("l_returnflag").agg(state.shared_threshold(bound).alias("threshold"))


_STATE_SQL = """
    WITH stored AS (
        SELECT event_type AS object_name, max(ts) AS watermark, 'full' AS last_mode, 'SUCCESS' AS last_status,
               count(*) AS last_rows, TIMESTAMP '2024-02-01' AS last_run_at
        FROM events WHERE event_type <> 'signup' GROUP BY event_type),
    outcome AS (
        SELECT event_type AS object_name, TIMESTAMP '2024-03-01' AS watermark, 'incremental' AS last_mode,
               count(*) AS last_rows, TIMESTAMP '2024-03-01' AS last_run_at
        FROM events WHERE value > 90 AND event_type IN ('signup', 'click') GROUP BY event_type)"""


def _stored(t: Tables):
    return t.events.filter("event_type <> 'signup'").groupBy(F.col("event_type").alias("object_name")).agg(
        F.max("ts").cast("timestamp").alias("watermark"), F.lit("full").alias("last_mode"),
        F.lit("SUCCESS").alias("last_status"), F.count(F.lit(1)).alias("last_rows"),
        F.lit("2024-02-01").cast("timestamp").alias("last_run_at"))


def _outcome(t: Tables):
    run = F.lit("2024-03-01").cast("timestamp")
    return (t.events.filter("value > 90 AND event_type IN ('signup', 'click')")
            .groupBy(F.col("event_type").alias("object_name"))
            .agg(F.count(F.lit(1)).alias("last_rows"))
            .select("object_name", run.alias("watermark"), F.lit("incremental").alias("last_mode"), "last_rows",
                    run.alias("last_run_at"), F.lit("boom").alias("last_error")))


@query("state_success", _STATE_SQL + """
    SELECT object_name, epoch_us(watermark) AS watermark, last_mode, last_status, last_rows,
           epoch_us(last_run_at) AS last_run_at FROM stored WHERE object_name NOT IN (SELECT object_name FROM outcome)
    UNION ALL SELECT object_name, epoch_us(watermark), last_mode, 'SUCCESS', last_rows, epoch_us(last_run_at) FROM outcome""")
def state_success(t: Tables):
    return state.record_success(_stored(t), _outcome(t))


@query("state_failure", _STATE_SQL + """
    SELECT coalesce(s.object_name, o.object_name) AS object_name, epoch_us(s.watermark) AS watermark,
           coalesce(o.last_mode, s.last_mode) AS last_mode,
           CASE WHEN o.object_name IS NULL THEN s.last_status ELSE 'FAILED' END AS last_status, s.last_rows,
           epoch_us(coalesce(o.last_run_at, s.last_run_at)) AS last_run_at
    FROM stored s FULL JOIN outcome o ON s.object_name = o.object_name""")
def state_failure(t: Tables):
    return state.record_failure(_stored(t), _outcome(t))


@query("state_failure_with_error", _STATE_SQL + """
    SELECT coalesce(s.object_name, o.object_name) AS object_name, epoch_us(s.watermark) AS watermark,
           CASE WHEN o.object_name IS NULL THEN s.last_rows ELSE 0 END AS last_rows,
           CASE WHEN o.object_name IS NULL THEN '' ELSE 'boom' END AS last_error
    FROM stored s FULL JOIN outcome o ON s.object_name = o.object_name""")
def state_failure_with_error(t: Tables):
    stored = _stored(t).withColumn("last_error", F.lit(None).cast("string"))
    return state.record_failure(stored, _outcome(t)).select(
        "object_name", "watermark", "last_rows", F.coalesce("last_error", F.lit("")).alias("last_error"))


@query("sync_plan", _STATE_SQL + """
    SELECT t.object_name, CASE WHEN t.object_name = 'error' OR s.watermark IS NULL THEN 'full' ELSE 'cdc' END AS mode,
           CASE WHEN t.object_name = 'error' THEN 'no change tracking' WHEN s.watermark IS NULL THEN 'first run'
                ELSE '' END AS note,
           CASE WHEN s.object_name IS NULL THEN 'full' ELSE 'incremental' END AS table_mode
    FROM (SELECT DISTINCT event_type AS object_name FROM events) t LEFT JOIN stored s USING (object_name)""")
def sync_plan(t: Tables):
    objects = t.events.select(F.col("event_type").alias("object_name")).distinct()
    plan = state.state_plan(objects, _stored(t), full=False, always_full=["error"], changed="cdc")
    facts = plan.select("object_name", F.col("mode").alias("object_mode"), "note", "watermark",
                        F.lit(False).alias("full_requested"), F.col("watermark").isNotNull().alias("table_exists"))
    return state.table_plan(facts).select(
        "object_name", F.col("object_mode").alias("mode"), F.coalesce("note", F.lit("")).alias("note"),
        F.col("mode").alias("table_mode"))


@query("sync_report", _STATE_SQL + """
    SELECT o.object_name AS object, 'incremental' AS mode, 'FAILED' AS status, epoch_us(s.watermark) AS watermark
    FROM outcome o LEFT JOIN stored s USING (object_name)""")
def sync_report(t: Tables):
    report = state.run_report(state.record_failure(_stored(t), _outcome(t)))
    return state.failures(report).select("object", "mode", "status", "watermark")


@query("key_check", """
    SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys FROM lineitem""")
def key_check(t: Tables):
    return quality.key_check(t.lineitem, LINE_KEY)


# ---- trees ------------------------------------------------------------------------------

def _children(t: Tables):
    """region → nation → customer → order as child lists; orders are listed under their customer."""
    def listed(df, parent, seq, kind, id, **body):
        extra = "".join(f',"{k}":{v}' for k, v in body.items())
        return df.select(
            parent.alias("parent_id"), F.col(seq).cast("bigint").alias("seq"),
            F.concat(F.lit('{"object":"block","id":"'), id, F.lit('","type":"'), kind,
                     F.lit(f'","has_children":true{extra}}}')).alias("payload"))

    def node(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    segment = F.col("c_mktsegment")
    kind = F.when(segment == "BUILDING", "child_page").when(segment == "MACHINERY", "synced_block").otherwise("paragraph")
    synced = dict(synced_block='{"synced_from":{"block_id":"b"}}')
    return (listed(t.nation, node("r", "n_regionkey"), "n_nationkey", F.lit("paragraph"), node("n", "n_nationkey"))
            .unionByName(listed(t.customer, node("n", "c_nationkey"), "c_custkey", kind, node("c", "c_custkey"), **synced))
            .unionByName(listed(t.orders, node("c", "o_custkey"), "o_orderkey", F.lit("paragraph"), node("o", "o_orderkey"))))


@query("tree_walk", """
    WITH nations AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS p0 FROM nation),
         customers AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS p1 FROM customer),
         o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS p2 FROM orders)
    SELECT 'r' || n_regionkey AS page_id, 'n' || n_nationkey AS id, 0 AS depth, p0 AS position,
           CAST(p0 AS VARCHAR) AS path FROM nations
    UNION ALL
    SELECT 'r' || n_regionkey, 'c' || c_custkey, 1, p1, p0 || '/' || p1
    FROM customers JOIN nations ON c_nationkey = n_nationkey
    UNION ALL
    SELECT 'r' || n_regionkey, 'o' || o_orderkey, 2, p2, p0 || '/' || p1 || '/' || p2
    FROM o JOIN customers ON o_custkey = c_custkey JOIN nations ON c_nationkey = n_nationkey
    WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def tree_walk(t: Tables):
    roots = t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("page_id"))
    blocks = tree.page_blocks(roots, _children(t))
    return blocks.select("page_id", F.get_json_object("payload", "$.id").alias("id"), "depth", "position",
                         F.array_join(F.col("path").cast("array<string>"), "/").alias("path"))


@query("tree_cycles", """
    SELECT 'c' || c_custkey AS page_id, prefix || c_custkey AS id, depth, position, path
    FROM customer, (VALUES ('z', 0, 0, '0'), ('b', 0, 1, '1'), ('c', 1, 0, '1/0')) v(prefix, depth, position, path)""")
def tree_cycles(t: Tables):
    """Pages that list themselves and are listed by their own block, whose lists were landed twice, and a child without order."""
    number = F.col("c_custkey").cast("string")

    def child(prefix, seq, landing, below="c"):
        payload = F.concat(F.lit(f'{{"object":"block","type":"paragraph","has_children":{str(prefix != "z").lower()},"id":"{prefix}'), number, F.lit('"}'))
        return t.customer.select(F.concat(F.lit(below), number).alias("parent_id"), F.lit(seq).cast("int").alias("seq"),
                                 F.lit(landing).alias("landing"), payload.alias("payload"))

    children = reduce(DataFrame.unionByName, [
        child("old", 0, 1), child("z", None, 2), child("b", 1, 2), child("c", 1, 2), child("c", 0, 2, below="b")])
    pages = t.customer.select(F.concat(F.lit("c"), number).alias("page_id"))
    blocks = tree.page_blocks(pages, children, landing="landing")
    return blocks.select("page_id", F.get_json_object("payload", "$.id").alias("id"), "depth", "position",
                         F.array_join(F.col("path").cast("array<string>"), "/").alias("path"))


@query("page_outcomes", """
    SELECT CASE WHEN source IN ('src1', 'src2') THEN 'trashed'
                WHEN lang = 'es' THEN 'skipped' ELSE 'walked' END AS outcome, count(*) AS n_pages
    FROM documents WHERE source <> 'src7' GROUP BY 1""")
def page_outcomes(t: Tables):
    refs = page_refs(changes_since(landed.pages(t), "page"))
    unreadable = t.documents.filter("lang = 'es'").select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("page_id"))
    outcomes = (refs.filter("in_trash").select(F.lit("trashed").alias("outcome"))
                .unionByName(skipped_pages(refs, unreadable).select(F.lit("skipped").alias("outcome")))
                .unionByName(readable_pages(refs, unreadable).select(F.lit("walked").alias("outcome"))))
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_pages"))


@query("keyset_chunks", """
    WITH ranked AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer),
         chunks AS (SELECT i // 400 AS chunk, min(id) AS first_id, max(id) AS last_id, count(*) AS n_ids
                    FROM ranked GROUP BY 1)
    SELECT chunk, coalesce(lag(last_id) OVER (ORDER BY chunk), -1) AS after_id, first_id, last_id, n_ids FROM chunks""")
def keyset(t: Tables):
    chunks = keyset_chunks(t.customer.select(F.col("c_custkey").cast("string").alias("id")), "id", 400)
    return chunks.withColumn("after_id", F.coalesce("after_id", F.lit(-1)))
