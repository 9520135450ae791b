"""Record mappings over landed payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync.catalog import Tables, landed, query
from lakesync.functions.payload import canonical, first_title, parsed, text_at
from lakesync.mapping import crm, workspace
from lakesync.mapping.issue import issue_rows, requested_fields

CHANGED = "1704067200000000 + ({key} % 525600) * 60000000"
RUN_MICROS = "1717200000000000"  # 2024-06-01


def contact_sql(suffix: str = "") -> str:
    return f"""CAST(c_custkey AS VARCHAR) AS id, 1704067200000000 AS created_at,
        {CHANGED.format(key="c_custkey")} AS updated_at, c_acctbal < 0 AS archived,
        CASE WHEN c_acctbal < 0 THEN {CHANGED.format(key="c_custkey")} END AS archived_at,
        'c' || c_custkey || '@example.com' AS email, 'Customer' AS first_name, c_name || '{suffix}' AS last_name,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) END AS phone,
        c_mktsegment AS lifecycle_stage, {RUN_MICROS} AS _ingested_at"""


@query("map_contact", f"SELECT {contact_sql()} FROM customer")
def map_contact(t: Tables):
    return crm.object_rows(landed.contacts(t), "contacts", landed.RUN_AT).drop("raw_json")


@query("map_company", f"""
    SELECT CAST(s_suppkey AS VARCHAR) AS id, 1704067200000000 AS created_at,
           {CHANGED.format(key="s_suppkey")} AS updated_at, false AS archived, s_name AS name,
           's' || s_suppkey || '.example.com' AS domain, CAST(s_nationkey AS VARCHAR) AS industry FROM supplier""")
def map_company(t: Tables):
    return crm.object_rows(landed.companies(t), "companies", landed.RUN_AT).drop("raw_json", "archived_at", "_ingested_at")


DEAL_SQL = """CAST(o_orderkey AS VARCHAR) AS id, epoch_us(o_orderdate) AS created_at, epoch_us(o_orderdate) AS updated_at,
    o_orderstatus = 'F' AS archived, CASE WHEN o_orderstatus = 'F' THEN epoch_us(o_orderdate) END AS archived_at,
    o_orderpriority AS deal_name, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,6)) AS VARCHAR) AS amount,
    'USD' AS currency, o_orderstatus AS deal_stage, 'default' AS pipeline, epoch_us(o_orderdate) AS close_date,
    CAST(o_custkey AS VARCHAR) AS owner_id"""


@query("map_deal", f"SELECT {DEAL_SQL} FROM orders")
def map_deal(t: Tables):
    return crm.object_rows(landed.deals(t), "deals", landed.RUN_AT).drop("raw_json", "_ingested_at")


def issue_sql(suffix: str = "") -> str:
    return f"""'ORD-' || o_orderkey AS key, 'order ' || o_orderkey || '{suffix}' AS summary, o_orderstatus AS status,
        o_orderpriority AS priority, c_name AS assignee,
        CASE WHEN o_orderpriority <> '1-URGENT' THEN 'Desk' END AS reporter, 'Order' AS issuetype, 'SALES' AS project,
        epoch_us(o_orderdate) AS created, epoch_us(o_orderdate) + (o_orderkey % 86400) * 1000000 AS updated,
        CASE WHEN o_orderstatus = 'P' THEN '{{"customfield_1":{{"value":"' || c_mktsegment
             || '"}},"customfield_2":' || o_custkey || '}}' END AS raw_fields"""


@query("map_issue", f"SELECT {issue_sql()} FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def map_issue(t: Tables):
    rows = issue_rows(landed.issues(t))
    wanted = [c for c in requested_fields() if c in rows.columns]
    return rows.select(*wanted, "raw_fields")


WORKSPACE_PAGE = f"""
    SELECT 'p' || doc_id AS id, 1704067200000000 AS created_time,
           CASE WHEN source <> 'src7' THEN {CHANGED.format(key="doc_id")} END AS last_edited_time,
           'u1' AS created_by_id, source AS last_edited_by_id, source IN ('src1', 'src2') AS in_trash,
           CASE lang WHEN 'en' THEN 'page_id' WHEN 'fr' THEN 'workspace' WHEN 'de' THEN 'data_source_id' END AS parent_type,
           CASE lang WHEN 'en' THEN 'p' || doc_id WHEN 'de' THEN 'd' || doc_id END AS parent_id,
           'https://ws.example.com/p' || doc_id AS url,
           CASE source WHEN 'src4' THEN NULL WHEN 'src5' THEN '' ELSE source || ' ' || lang || '{{suffix}}' END AS title
    FROM documents"""


@query("map_page", WORKSPACE_PAGE.format(suffix=""))
def map_page(t: Tables):
    return workspace.page_rows(landed.pages(t), landed.RUN_AT).drop("raw_json", "public_url", "_ingested_at")


@query("map_data_source", """
    SELECT CAST(n_nationkey AS VARCHAR) AS id, 'database_id' AS parent_type, r_name AS parent_id,
           'https://ws.example.com/' || n_name AS url, CASE WHEN n_regionkey > 0 THEN n_name || '!' END AS title,
           false AS in_trash, epoch_us(TIMESTAMP '2024-01-02') AS last_edited_time
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
def map_data_source(t: Tables):
    rows = workspace.data_source_rows(landed.data_sources(t), landed.RUN_AT)
    return rows.select("id", "parent_type", "parent_id", "url", "title", "in_trash", "last_edited_time")


@query("map_block", f"""
    SELECT conv_id || '-' || turn AS id, role AS type, false AS has_children, CAST(conv_id AS VARCHAR) AS page_id,
           0 AS depth, CAST(turn AS INTEGER) AS position, 'page_id' AS parent_type, CAST(conv_id AS VARCHAR) AS parent_id,
           {CHANGED.format(key="turn")} AS last_edited_time FROM conversations""")
def map_block(t: Tables):
    rows = workspace.block_rows(landed.blocks(t), landed.RUN_AT)
    return rows.select("id", "type", "has_children", "page_id", "depth", "position", "parent_type", "parent_id",
                       "last_edited_time")


@query("map_user", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'bot' ELSE 'person' END AS type,
           c_name AS name, CASE WHEN c_acctbal > 0 THEN 'https://img.example.com/' || c_custkey END AS avatar_url,
           CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey || '@example.com' END AS email FROM customer""")
def map_user(t: Tables):
    return workspace.user_rows(landed.users(t), landed.RUN_AT).drop("raw_json", "_ingested_at")


@query("raw_fields", """
    SELECT 'ORD-' || o_orderkey AS key, CAST(o_custkey AS VARCHAR) AS customer, c_mktsegment AS segment
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'""")
def raw_fields(t: Tables):
    rest = F.col("raw_fields")
    return issue_rows(landed.issues(t)).filter(rest.isNotNull()).select(
        "key", F.get_json_object(rest, "$.customfield_2").alias("customer"),
        F.get_json_object(rest, "$.customfield_1.value").alias("segment"))


@query("raw_json", """
    SELECT p_partkey, '{"brand":"' || p_brand || '","id":' || p_partkey || ',"size":{"a":null,"n":' || p_size
        || ',"z":"é"},"tags":["' || p_type || '","' || p_name || '"]}' AS raw_json FROM part""")
def raw_json(t: Tables):
    record = F.concat(
        F.lit('{ "tags": ["'), "p_type", F.lit('", "'), "p_name", F.lit('"], "size": {"z": "é", "n": '),
        F.col("p_size").cast("string"), F.lit(', "a": null}, "id": '), F.col("p_partkey").cast("string"),
        F.lit(', "brand": "'), "p_brand", F.lit('"}'))
    return t.part.select("p_partkey", canonical(parsed(record)).alias("raw_json"))


@query("polymorphic_parent", """
    SELECT CASE lang WHEN 'en' THEN 'page_id' WHEN 'fr' THEN 'workspace' WHEN 'de' THEN 'data_source_id' ELSE '' END
               AS parent_type,
           count(*) AS n_pages, count(*) FILTER (lang IN ('en', 'de')) AS n_ids FROM documents GROUP BY 1""")
def polymorphic_parent(t: Tables):
    kind, id = workspace.parent_of(F.col("r"))
    pages = landed.pages(t).select(parsed(F.col("payload")).alias("r"))
    return (pages.select(F.coalesce(kind, F.lit("")).alias("parent_type"), id.alias("id")).groupBy("parent_type")
            .agg(F.count(F.lit(1)).alias("n_pages"), F.count("id").alias("n_ids")))


@query("page_title", """
    SELECT coalesce(CASE source WHEN 'src4' THEN NULL WHEN 'src5' THEN '' ELSE source || ' ' || lang END, '<none>')
               AS title, count(*) AS n_pages FROM documents GROUP BY 1""")
def page_title(t: Tables):
    title = F.coalesce(first_title(F.col("payload")), F.lit("<none>"))
    return landed.pages(t).groupBy(title.alias("title")).agg(F.count(F.lit(1)).alias("n_pages"))


@query("trash_flag", """
    SELECT source, source IN ('src1', 'src2') AS in_trash, count(*) AS n_pages FROM documents GROUP BY 1, 2""")
def trash_flag(t: Tables):
    record = F.col("r")
    pages = landed.pages(t).select(parsed(F.col("payload")).alias("r"))
    return (pages.select(text_at(record, "last_edited_by.id").alias("source"), workspace.in_trash(record).alias("in_trash"))
            .groupBy("source", "in_trash").agg(F.count(F.lit(1)).alias("n_pages")))
