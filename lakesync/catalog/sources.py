"""Listing, link and document sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesync.catalog import Tables, landed, query
from lakesync.mapping.crm import link_rows, open_cursors
from lakesync.operators import apply, paging, quality
from lakesync.plans.crm import deals_by_stage as by_stage
from lakesync.plans.crm import linked_names
from lakesync.plans.documents import first_schema
from lakesync.plans.issues import preview as first_issues
from lakesync.schemas import ASSOCIATIONS
from lakesync.sources import documents, listing
from lakesync.sources import schema_days as days
from lakesync.sources.landing import DAY

_ISSUE_SQL = "'ORD-' || o_orderkey AS key, epoch_us(o_orderdate) + (o_orderkey % 86400) * 1000000 AS updated"


@query("scan_listing", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def scan_listing(t: Tables):
    items = t.orders.select(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("item"))
    pages = landed.land(landed.paged(items), landed.json_object(results=F.col("results")))
    record = F.from_json("payload", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string")
    return listing.listing_items(pages).select(record.alias("r")).select("r.*")


@query("paging_check", """
    WITH pages AS (SELECT DISTINCT o_orderpriority AS listing, o_orderkey // 100 AS page FROM orders),
         marked AS (SELECT *, page = max(page) OVER (PARTITION BY listing) AS last FROM pages)
    SELECT listing, count(*) AS n_pages,
           count(DISTINCT CASE WHEN last AND listing <> '5-LOW' THEN NULL WHEN listing = '3-MEDIUM' THEN page // 2
                               ELSE page + 1 END) AS n_tokens,
           CASE listing WHEN '3-MEDIUM' THEN 'repeated token' WHEN '4-NOT SPECIFIED'
                THEN 'no token on a page that is not last' WHEN '5-LOW' THEN 'no last page' ELSE 'ok' END AS status
    FROM marked GROUP BY listing""")
def paging_check(t: Tables):
    kind = F.col("listing")
    pages = t.orders.select(F.col("o_orderpriority").alias("listing"), F.expr("o_orderkey div 100").alias("page")).distinct()
    last = pages.groupBy("listing").agg(F.max("page").alias("_last"))
    end = F.col("page") == F.col("_last")
    # each faulty listing breaks one paging rule
    headers = pages.join(last, "listing").select(
        "listing",
        F.when(end & (kind != "5-LOW"), None).when(kind == "3-MEDIUM", F.expr("page div 2")).otherwise(F.col("page") + 1)
        .cast("string").alias("token"),
        # some pages do not say whether they are the last one
        F.when(~(end & (kind == "4-NOT SPECIFIED")) & ((kind != "2-HIGH") | end), end & (kind != "5-LOW")).alias("is_last"))
    return quality.paging_faults(headers, "listing", strict=True)


_CHAIN_SQL = """
    WITH pages AS (SELECT DISTINCT o_orderpriority AS listing, o_orderkey // 100 AS page FROM orders),
    chain AS (SELECT listing, CASE WHEN row_number() OVER w > 1 THEN CAST(page AS VARCHAR) END AS asked, row_number() OVER w AS pos,
                     CAST(lead(page) OVER w AS VARCHAR) AS token, count(*) OVER (PARTITION BY listing) AS n
              FROM pages WINDOW w AS (PARTITION BY listing ORDER BY page)),
    landed AS (SELECT *, CASE listing WHEN '1-URGENT' THEN pos > 1 WHEN '2-HIGH' THEN pos % 10 <> 5 OR pos = n WHEN '3-MEDIUM' THEN pos < n ELSE true END AS here
               FROM chain),
    named AS (SELECT *, lag(here) OVER w AS here_before, lead(here) OVER w AS here_after
              FROM landed WINDOW w AS (PARTITION BY listing ORDER BY pos))"""


def _chained_pages(t: Tables):
    """Orders in pages of a hundred keys, a listing per priority: of three listings the first, the last or every tenth page but the last is lost."""
    place = Window.partitionBy("listing").orderBy("page")
    pages = t.orders.select(F.col("o_orderpriority").alias("listing"), F.expr("o_orderkey div 100").alias("page")).distinct()
    chain = pages.select(
        "listing", F.when(F.row_number().over(place) > 1, F.col("page").cast("string")).alias("asked"), F.row_number().over(place).alias("at"),
        F.lead("page").over(place).cast("string").alias("token"))
    lost = (F.when(F.col("listing") == "1-URGENT", F.col("at") == 1).when(F.col("listing") == "2-HIGH", (F.col("at") % 10 == 5) & F.col("token").isNotNull())
            .when(F.col("listing") == "3-MEDIUM", F.col("token").isNull()).otherwise(False))
    # one listing ends by a last cursor that leads back into it
    last = F.col("token").isNull()
    back = F.when(last & (F.col("listing") == "4-NOT SPECIFIED"), F.col("asked")).otherwise(F.col("token"))
    return chain.where(~lost).select("listing", "asked", back.alias("token"), (last & (F.col("listing") != "4-NOT SPECIFIED")).alias("is_last"))


@query("paging_chain", _CHAIN_SQL + f"""
    SELECT listing, '{paging.FIRST}' AS fault, NULL AS cursor FROM named WHERE NOT here AND pos = 1
    UNION ALL SELECT listing, '{paging.NEXT}', asked FROM named WHERE NOT here AND here_before AND pos < n
    UNION ALL SELECT listing, '{paging.BEFORE}', asked FROM named WHERE here AND NOT here_before
    UNION ALL SELECT listing, '{paging.LAST}', asked FROM named WHERE NOT here AND pos = n
    UNION ALL SELECT listing, '{paging.TWICE}', asked FROM named WHERE listing = '4-NOT SPECIFIED' AND pos = n
    UNION ALL SELECT listing, '{paging.LAST}', NULL FROM named WHERE listing = '4-NOT SPECIFIED' AND pos = n""")
def paging_chain(t: Tables):
    return paging.chain_faults(_chained_pages(t))


@query("page_places", _CHAIN_SQL + """
    , runs AS (SELECT *, max(CASE WHEN NOT here_before OR (listing = '4-NOT SPECIFIED' AND pos = n) THEN pos END) OVER
                  (PARTITION BY listing ORDER BY pos) AS begun FROM named WHERE here)
    SELECT r.listing, r.asked, b.asked AS run, r.pos - coalesce(r.begun, 1) AS place
    FROM runs r LEFT JOIN named b ON b.listing = r.listing AND b.pos = r.begun""")
def page_places(t: Tables):
    return paging.page_places(_chained_pages(t))


@query("batch_read", "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def batch_read(t: Tables):
    return listing.read_by_ids(t.documents.select("doc_id", "lang", "source", "n_chars"), t.labels, "doc_id")


@query("missing_ids", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_ids(t: Tables):
    return listing.missing_ids(t.labels, t.documents, "doc_id")


@query("error_triage", """
    SELECT CASE lang WHEN 'de' THEN 'VALIDATION_ERROR' ELSE '' END AS category, source, count(*) AS n_errors
    FROM documents WHERE lang IN ('de', 'es') GROUP BY 1, 2""")
def error_triage(t: Tables):
    lang = F.col("lang")
    category = (F.when(lang == "en", "OBJECT_NOT_FOUND").when(lang == "fr", "NO_ASSOCIATIONS_FOUND")
                .when(lang == "de", "VALIDATION_ERROR"))
    error = F.struct(F.lit("error").alias("status"), category.alias("category"), F.col("source").alias("message"))
    answers = landed.land(t.documents, landed.json_object(errors=F.array(error)))
    found = quality.untolerated_errors(answers, ["OBJECT_NOT_FOUND", "NO_ASSOCIATIONS_FOUND"])
    return found.groupBy(F.coalesce("category", F.lit("")).alias("category"), F.col("message").alias("source")).agg(
        F.count(F.lit(1)).alias("n_errors"))


@query("link_cursors", """
    WITH lines AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS n FROM lineitem),
         ends AS (SELECT o, max(n) AS n, count(*) AS c FROM lines GROUP BY o)
    SELECT CAST(o AS VARCHAR) AS from_id, CAST(n AS VARCHAR) AS cursor FROM ends WHERE c > 1 AND o % 7 = 3""")
def link_cursors(t: Tables):
    # one page per line of an order, each naming the next; every seventh order lacks its last page
    lines = t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n")).distinct()
    orders = lines.groupBy("o").agg(F.sort_array(F.collect_set("n")).alias("ns"))
    steps = orders.select("o", F.size("ns").alias("c"), F.col("ns")[0].alias("first"), F.posexplode("ns").alias("i", "n"), F.col("ns").alias("all"))
    steps = steps.where(~((F.col("o") % 7 == 3) & (F.col("c") > 1) & (F.col("i") == F.col("c") - 1)))
    after = F.get("all", F.col("i") + 1).cast("string")
    result = F.struct(F.struct(landed.text("o").alias("id")).alias("from"), F.struct(F.struct(after.alias("after")).alias("next")).alias("paging"))
    cursor = F.when(F.col("n") != F.col("first"), landed.text("n"))
    return open_cursors(landed.land(steps, landed.json_object(results=F.array(result)), cursor.alias("cursor")))


@query("live_plus_archived", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus = 'F' AS archived FROM orders")
def live_plus_archived(t: Tables):
    records = landed.deals(t)

    def ids(part, flag):
        return part.select(F.get_json_object("payload", "$.id").alias("id"), F.lit(flag).alias("archived"))

    return ids(listing.live(records), False).unionByName(ids(listing.archived(records), True))


@query("archived_ids", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, 1704067200000000 + (c_custkey % 525600) * 60000000 AS archived_at
    FROM customer WHERE c_acctbal < 0""")
def archived_ids(t: Tables):
    return listing.archived_ids(landed.contacts(t))


@query("property_names", """
    SELECT DISTINCT 'size_' || p_size AS name FROM part UNION SELECT 'brand' UNION SELECT 'type'""")
def property_names(t: Tables):
    records = landed.land(t.part, F.concat(
        F.lit('{"properties":{"brand":"'), "p_brand", F.lit('","type":"'), "p_type", F.lit('","size_'),
        F.col("p_size").cast("string"), F.lit('":1}}')))
    return listing.property_names(records)


# ---- links --------------------------------------------------------------------------

def _link_sql(to: str, name: str, frm: str = "orders") -> str:
    return f"""
    SELECT '{frm}' AS from_object, CAST(l_orderkey AS VARCHAR) AS from_id, '{name}' AS to_object,
           CAST({to} AS VARCHAR) AS to_id, kind.id AS association_type_id, kind.category, kind.label
    FROM lineitem, LATERAL (SELECT l_linenumber AS id, 'A' AS category, NULL AS label
        UNION ALL SELECT CASE WHEN l_returnflag <> 'A' THEN l_linenumber END, 'B', l_returnflag) kind"""


def _links(t: Tables, to: str, name: str):
    return link_rows(landed.link_pages(t, to), "orders", name, landed.RUN_AT)


@query("link_explode", _link_sql("l_partkey", "parts") + " UNION ALL " + _link_sql("l_suppkey", "suppliers"))
def link_explode(t: Tables):
    links = _links(t, "l_partkey", "parts").unionByName(_links(t, "l_suppkey", "suppliers"))
    return links.drop("_ingested_at")


@query("link_sources", f"""
    SELECT to_object, category, count(*) AS n_links, count(DISTINCT from_id) AS n_sources FROM (
        {_link_sql("l_partkey", "parts")} UNION ALL {_link_sql("l_suppkey", "suppliers")}
        UNION ALL {_link_sql("l_linenumber", "lines")}) links
    WHERE from_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'O')
    GROUP BY to_object, category""")
def link_sources(t: Tables):
    # P orders have an unknown flag, which does not count as live
    table = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.when(
        F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("archived"))
    sources = listing.live_ids(table).withColumnRenamed("id", "from_id")
    links = (_links(t, "l_partkey", "parts").unionByName(_links(t, "l_suppkey", "suppliers"))
             .unionByName(_links(t, "l_linenumber", "lines")))
    read = listing.read_by_ids(links, sources, "from_id")
    per_source = read.groupBy("to_object", "category", "from_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_source.groupBy("to_object", "category").agg(
        F.sum("_n").alias("n_links"), F.count(F.lit(1)).alias("n_sources"))


@query("link_partial", f"""
    WITH part_links AS (SELECT DISTINCT * FROM ({_link_sql("l_partkey", "parts")})),
         supplier_links AS (SELECT DISTINCT from_object, from_id, to_object, to_id, association_type_id FROM
                            ({_link_sql("l_suppkey", "suppliers")}))
    SELECT to_object, association_type_id IS NULL AS unknown_type, count(*) AS n_links FROM (
        SELECT from_object, from_id, to_object, to_id, association_type_id FROM part_links GROUP BY ALL
        -- a link of unknown type matches nothing, so the merge adds it a second time
        UNION ALL SELECT DISTINCT from_object, from_id, to_object, to_id, association_type_id
            FROM part_links WHERE association_type_id IS NULL
        UNION ALL SELECT * FROM supplier_links)
    GROUP BY 1, 2""")
def link_partial(t: Tables):
    key, order_by = list(ASSOCIATIONS.key), ASSOCIATIONS.order_by
    parts = _links(t, "l_partkey", "parts")
    stored = apply.overwrite(parts, key, order_by, ["category"])
    run = parts.unionByName(_links(t, "l_suppkey", "suppliers"))
    merged = apply.upsert(stored, run, key, order_by, ["category"])
    return (merged.groupBy("to_object", F.col("association_type_id").isNull().alias("unknown_type"))
            .agg(F.count(F.lit(1)).alias("n_links")))


@query("link_join", """
    SELECT o_orderpriority AS from_name, s_name AS to_name, 2 * count(*) AS n_links
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY o_orderpriority, s_name""")
def link_join(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), "o_orderpriority")
    suppliers = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), "s_name")
    links = linked_names(_links(t, "l_suppkey", "suppliers"), orders, suppliers, "o_orderpriority", "s_name")
    return links.groupBy("from_name", "to_name").agg(F.count(F.lit(1)).alias("n_links"))


# ---- documents ------------------------------------------------------------------------

_ID = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER))"
_PRICE = "CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,10)) AS VARCHAR)"


@query("doc_scan", f"""
    SELECT {_ID} AS _id, epoch_us(l_shipdate) AS shipped, {_PRICE} AS price, CAST(l_linenumber AS BIGINT) AS number, flag
    FROM lineitem, LATERAL (SELECT l_returnflag AS flag UNION ALL SELECT l_linestatus) f""")
def doc_scan(t: Tables):
    lines = landed.documents(t)
    docs = documents.read_documents(lines, first_schema(lines, watermark_field="shipped"), "shipped")
    return docs.select("_id", "shipped", "price", F.col("line.number").alias("number"), F.explode("flags").alias("flag"))


@query("schema_reuse", f"""
    SELECT {_ID} AS _id, l_orderkey AS order_no, epoch_us(l_shipdate) AS shipped FROM lineitem""")
def schema_reuse(t: Tables):
    first = landed.documents(t)
    stored = documents.read_documents(first.filter("l_linestatus = 'F'"), documents.read_schema(
        documents.document_schema(first), ["mixed"], ["_id", "order_no", "shipped", "mixed"]))
    # the later batch has a new field; reading with the stored schema leaves it out
    later = documents.read_documents(landed.documents(t, extra=True).filter("l_linestatus <> 'F'"), stored.schema)
    return apply.upsert(stored, later, ["_id"], "shipped").select(
        "_id", "order_no", F.col("shipped").cast("timestamp").alias("shipped"))


@query("prune_fields", f"SELECT {_ID} AS _id, {_PRICE} AS price, epoch_us(l_shipdate) AS shipped FROM lineitem")
def prune_fields(t: Tables):
    lines = landed.documents(t)
    return documents.read_documents(lines, first_schema(lines, fields=["price"], watermark_field="shipped"))


@query("string_fields", """
    SELECT CASE WHEN l_returnflag = 'N' THEN 'N' ELSE CAST(l_linenumber AS VARCHAR) END AS mixed, count(*) AS n_docs
    FROM lineitem GROUP BY 1""")
def string_fields(t: Tables):
    lines = landed.documents(t)
    schema = documents.read_schema(documents.document_schema(lines), ["mixed"], documents.kept_fields(["mixed"]))
    return documents.read_documents(lines, schema).groupBy("mixed").agg(F.count(F.lit(1)).alias("n_docs"))


_FIELDS_SQL = """
    SELECT name, type, (SELECT count(*) FROM lineitem) AS n_values FROM (VALUES
        ('_id', 'string'), ('order_no', 'bigint'), ('shipped', 'string'), ('mixed', 'string'),
        ('price', 'decimal(38,10)'), ('line', 'struct<number:bigint,quantity:decimal(38,10)>'),
        ('flags', 'array<string>')) v(name, type)"""


@query("schema_widen", _FIELDS_SQL)
def schema_widen(t: Tables):
    lines = landed.documents(t)
    return _field_counts(lines, documents.read_schema(documents.document_schema(lines)))


@query("schema_days", _FIELDS_SQL)
def schema_days(t: Tables):
    """The same from one schema per landed day (here the month shipped): the later half of the days is read in a second run."""
    month = F.to_date(F.trunc(F.col("l_shipdate").cast("date"), "month"))
    lines = landed.documents(t).withColumn(DAY, month)
    first = days.day_schemas(lines.where(F.col(DAY) < "1996-01-01"))
    known = t.spark.createDataFrame(first.collect(), days.STATE)  # a row a day
    state = days.updated(known, days.day_schemas(lines, known))
    found = days.whole_schema(r["found"] for r in state.collect())
    return _field_counts(lines.drop(DAY), documents.read_schema(documents.documents_type(found)))


def _field_counts(lines: DataFrame, schema):
    docs = documents.read_documents(lines, schema)
    counted = docs.agg(F.map_from_entries(F.array(*[
        F.struct(F.lit(f"{f.name}:{f.dataType.simpleString()}"), F.count(F.col(f.name))) for f in schema.fields])).alias("m"))
    named = counted.select(F.explode("m").alias("field", "n_values"))
    return named.select(F.regexp_extract("field", "^([^:]+):(.*)$", 1).alias("name"),
                        F.regexp_extract("field", "^([^:]+):(.*)$", 2).alias("type"), "n_values")


@query("doc_rare", """
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(CASE WHEN l_partkey % 997 = 5 THEN l_quantity + 0.5 ELSE l_quantity END AS DECIMAL(38,1))::VARCHAR AS size,
           CASE WHEN l_partkey % 997 = 5 THEN l_comment_no END AS seldom
    FROM (SELECT *, CAST(l_orderkey AS VARCHAR) AS l_comment_no FROM lineitem)""")
def doc_rare(t: Tables):
    # few documents have the field, and in the same ones a number is wider than in all others
    few = F.pmod("l_partkey", F.lit(997)) == 5
    size = F.when(few, (F.col("l_quantity") + 0.5).cast("decimal(9,1)").cast("string")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    rest = F.when(few, F.concat(F.lit(',"seldom":"'), landed.text("l_orderkey"), F.lit('"}'))).otherwise("}")
    lines = landed.land(t.lineitem, F.concat(F.lit('{"_id":"'), F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey"), F.lit('","size":'), size, rest))
    docs = documents.read_documents(lines, first_schema(lines))
    key = [F.split("_id", "-")[i].cast("bigint").alias(name) for i, name in enumerate(("l_orderkey", "l_partkey", "l_suppkey"))]
    return docs.select(*key, F.col("size").cast("decimal(38,1)").cast("string").alias("size"), "seldom")


@query("doc_types", """
    SELECT 'o' || o_orderkey AS _id, epoch_us(o_orderdate) AS placed, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,10)) AS VARCHAR) AS total,
           o_custkey AS customer, 'a {"$oid":"x"}' AS note FROM orders""")
def doc_types(t: Tables):
    # as an export spells types JSON does not have; the note only looks like one
    lines = landed.land(t.orders, F.concat(
        F.lit('{"_id":{"$oid":"o'), landed.text("o_orderkey"), F.lit('"},"placed":{"$date":"'), landed.iso(F.col("o_orderdate").cast("timestamp")),
        F.lit('"},"total":{"$numberDecimal":"'), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit('"},"customer":{ "$numberLong" : "'),
        landed.text("o_custkey"), F.lit(r'"},"note":"a {\"$oid\":\"x\"}"}')))
    docs = documents.read_documents(lines, first_schema(lines))
    return docs.select("_id", "placed", "total", "customer", "note")


@query("probe", "SELECT count(*) AS n_docs FROM (SELECT 1 FROM lineitem LIMIT 1)")
def probe(t: Tables):
    return documents.probe(landed.documents(t)).agg(F.count("payload").alias("n_docs"))


# ---- documented queries over the tables ------------------------------------------------

@query("deals_by_stage", """
    SELECT o_orderstatus AS deal_stage, count(*) AS n_deals,
           CAST(sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,6))) AS VARCHAR) AS amount
    FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus""")
def deals_by_stage(t: Tables):
    from lakesync.mapping.crm import object_rows

    return by_stage(object_rows(landed.deals(t), "deals", landed.RUN_AT))


@query("recent_topk", """
    SELECT doc_id, source, n_chars, 1704067200000000 + (doc_id % 525600) * 60000000 AS edited
    FROM documents ORDER BY edited DESC, doc_id LIMIT 20""")
def recent_topk(t: Tables):
    docs = t.documents.select("doc_id", "source", "n_chars", landed.minutes_after_base("doc_id").alias("edited"))
    return docs.orderBy(F.desc("edited"), "doc_id").limit(20)


@query("preview", f"""
    SELECT {_ISSUE_SQL}, o_orderpriority AS priority FROM orders WHERE o_orderstatus = 'O' ORDER BY updated, key LIMIT 10""")
def preview(t: Tables):
    return first_issues(landed.issues(t), 10, F.col("status") == "O").select("key", "updated", "priority")
