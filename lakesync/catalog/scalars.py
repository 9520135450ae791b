"""Scalar functions over text derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync.catalog import Tables, landed, query
from lakesync.functions import text, times, values
from lakesync.functions.payload import once
from lakesync.operators import windows

_URI = "mongodb+srv://the:token@mail1.example.com:27017/db"


def _events(t: Tables):
    return t.events.withColumn("at", F.col("ts").cast("timestamp"))


@query("to_time", """
    SELECT event_id, CASE event_type
        WHEN 'click' THEN epoch_us(ts) // 1000 * 1000
        WHEN 'view' THEN epoch_us(ts) - 7200000000
        WHEN 'signup' THEN epoch_us(date_trunc('day', ts))
        WHEN 'purchase' THEN epoch_us(ts) END AS at
    FROM events""")
def to_time(t: Tables):
    kind, at = F.col("event_type"), F.col("at")
    spelled = (F.when(kind == "click", F.concat(F.lit(" "), F.unix_millis(at).cast("string")))
               .when(kind == "view", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
               .when(kind == "signup", F.date_format(at, "yyyy-MM-dd"))
               .when(kind == "purchase", F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS'999z'"))
               .otherwise(F.date_format(at, "yyyy-MM-dd'T25:'mm:ss")))
    return once(_events(t), spelled=spelled).select("event_id", times.to_time(F.col("spelled")).alias("at"))


@query("parse_ts_iso", """
    SELECT event_id, CASE event_type
        WHEN 'click' THEN epoch_us(date_trunc('minute', ts))
        WHEN 'view' THEN epoch_us(ts) + 19800000000
        WHEN 'signup' THEN epoch_us(date_trunc('second', ts))
        WHEN 'purchase' THEN epoch_us(date_trunc('hour', ts)) END AS at
    FROM events""")
def parse_ts_iso(t: Tables):
    kind, at = F.col("event_type"), F.col("at")
    spelled = (F.when(kind == "click", F.date_format(at, "yyyy-MM-dd'T'HH:mm'Z'"))
               .when(kind == "view", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-0530'"))
               .when(kind == "signup", F.date_format(at, "yyyyMMdd'T'HHmmss"))
               .when(kind == "purchase", F.date_format(at, "yyyy-MM-dd' 'HH"))
               .otherwise(""))
    return once(_events(t), spelled=spelled).select("event_id", times.parse_iso(F.col("spelled")).alias("at"))


@query("parse_ts_strict", "SELECT event_id, epoch_us(ts) // 1000 * 1000 + 12600000000 AS at FROM events")
def parse_ts_strict(t: Tables):
    spelled = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS'-0330'")
    return once(_events(t), spelled=spelled).select(
        "event_id", times.parse_issue_time(F.col("spelled"), "updated").alias("at"))


@query("to_amount", """
    WITH parts AS (SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_linenumber,
                          l_partkey * 1000 + l_suppkey % 1000 AS micros FROM lineitem)
    SELECT l_orderkey, l_partkey, l_suppkey, CASE
        WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL
        -- a five after the sixth decimal goes to the even neighbour
        ELSE (CASE WHEN l_linestatus = 'F' THEN '-' ELSE '' END) || CAST(CAST(l_orderkey AS DECIMAL(38,6))
             + CAST(CAST(CASE WHEN l_returnflag = 'N' THEN micros + micros % 2 ELSE micros + 1 END AS DECIMAL(38,0))
                    AS DECIMAL(38,6)) / 1000000 AS DECIMAL(38,6)) END AS amount
    FROM parts""")
def to_amount(t: Tables):
    micros = F.col("l_partkey") * 1000 + F.pmod("l_suppkey", F.lit(1000))
    whole = F.col("l_orderkey") + F.floor(micros / 1_000_000)
    digits = F.lpad(F.pmod(micros, F.lit(1_000_000)).cast("string"), 6, "0")
    # ties for N, just over the tie beyond DECIMAL(38,18) for the others, and text that is no number
    spelled = F.concat(
        F.when(F.col("l_linestatus") == "F", " -").otherwise(""), whole.cast("string"), F.lit("."), digits,
        F.when(F.col("l_returnflag") == "N", "50").otherwise("50000000000000000000000001"))
    # the same number with its point moved, for every other line number
    moved = F.concat(F.when(F.col("l_linestatus") == "F", "-").otherwise(""), F.lit("0.0"), whole.cast("string"), digits,
                     F.when(F.col("l_returnflag") == "N", "50").otherwise("50000000000000000000000001"),
                     F.lit("e+"), (F.length(whole.cast("string")) + 1).cast("string"))
    spelled = F.when(F.col("l_linenumber") % 2 == 0, moved).otherwise(spelled)
    bad = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    lines = t.only("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber")
    landed_text = once(landed.dealt(lines), spelled=F.concat(spelled, F.when(bad, " USD").otherwise("")))
    return landed_text.select("l_orderkey", "l_partkey", "l_suppkey", values.to_amount(F.col("spelled")).alias("amount"))


@query("merged_ids", """
    SELECT CAST(c_custkey + n AS VARCHAR) AS id FROM customer, (VALUES (1), (2)) v(n) WHERE c_mktsegment = 'MACHINERY'""")
def merged_ids(t: Tables):
    from lakesync.mapping.crm import merged_away

    return merged_away(landed.contacts(t))


@query("tz_literal", """
    SELECT event_id, strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M') AS minute,
           strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS millis,
           epoch_us(ts) - 300000000 AS overlap_start FROM events""")
def tz_literal(t: Tables):
    at = F.col("at")
    return _events(t).select(
        "event_id", times.minute_in_zone(at, "Asia/Karachi").alias("minute"), times.utc_millis_text(at).alias("millis"),
        (windows.instant_micros(at) - 300 * 1_000_000).alias("overlap_start"))


@query("type_ids", """
    SELECT l_linenumber, l_returnflag, count(*) AS n_links,
           count(*) FILTER (l_returnflag <> 'A') AS n_text_ids, sum(l_linenumber) AS sum_number_ids
    FROM lineitem GROUP BY l_linenumber, l_returnflag""")
def type_ids(t: Tables):
    number = F.parse_json(F.concat(F.col("l_linenumber").cast("string"), F.lit(".75")))
    spelled = F.parse_json(F.concat(F.lit('"'), F.when(F.col("l_returnflag") == "A", "1.5").otherwise(
        F.col("l_linenumber").cast("string")), F.lit('"')))
    nodes = once(t.lineitem, number=number, spelled=spelled)
    return nodes.groupBy("l_linenumber", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_links"), F.count(values.type_id(F.col("spelled"))).alias("n_text_ids"),
        F.sum(values.type_id(F.col("number"))).alias("sum_number_ids"))


@query("json_extract", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(t: Tables):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("json_dynamic_path", "SELECT conv_id, turn, text FROM conversations")
def json_dynamic_path(t: Tables):
    blocks = landed.blocks(t).withColumn("type", F.get_json_object("payload", "$.type"))
    return blocks.select("conv_id", "turn", F.expr(
        "get_json_object(payload, concat('$.', type, '.rich_text[0].plain_text'))").alias("text"))


@query("mask_text", r"""
    WITH masked AS (SELECT doc_id, regexp_replace(regexp_replace(
        replace(replace(replace(text, 'mail1.example.com', '***'), 'token', '***'), 'the', '***'),
        '[\p{L}\p{M}\p{N}_.-]+\.example\.com', '<host>', 'g'), '\b(?:\d{1,3}\.){3}\d{1,3}\b', '<ip>', 'g') AS text
        FROM documents)
    SELECT doc_id, text, substring(text, 1, 1000) AS message FROM masked""")
def mask_text(t: Tables):
    masked = text.mask_uri(F.col("text"), _URI, host_suffixes=["example.com"])
    docs = landed.dealt(t.only("documents", "doc_id", "text"))
    return docs.select("doc_id", masked.alias("text")).withColumn("message", text.shortened(F.col("text"), 1000))


@query("classify_errors", """
    SELECT CASE WHEN contains(text, 'token = ') THEN 'secret' WHEN contains(text, '@mail') THEN 'address'
                WHEN contains(text, 'worthless') THEN 'abuse' ELSE 'other' END AS kind, lang, count(*) AS n_docs
    FROM documents GROUP BY 1, 2""")
def classify_errors(t: Tables):
    rules = [text.ErrorRule("token = ", "secret"), text.ErrorRule("@mail", "address"), text.ErrorRule("worthless", "abuse")]
    kind = text.classify(F.col("text"), rules, "other")
    return t.documents.groupBy(kind.alias("kind"), "lang").agg(F.count(F.lit(1)).alias("n_docs"))


@query("normalize_host", r"""
    SELECT page_id, CASE WHEN regexp_matches(host, '^([a-z0-9][a-z0-9-]*\.)+example\.(com|net)$') THEN host END AS host
    FROM (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS host FROM pages)""")
def normalize_host(t: Tables):
    site = F.concat(F.upper(F.regexp_extract("url", "^[a-z]+://[^/?#]+", 0)), F.lit("//"))
    return t.pages.select("page_id", text.normalize_host(
        site, r"^([a-z0-9][a-z0-9-]*\.)+example\.(com|net)$").alias("host"))
