"""Landed payloads derived from the tables, one record per row of a table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.catalog import Tables
from lakesync.functions.payload import once

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
BASE_MICROS = 1704067200000000
RUN_AT = datetime(2024, 6, 1, tzinfo=timezone.utc)
PAGE_SIZE = 100


def minutes_after_base(key: str) -> Column:
    """A change time within one year, spread by key."""
    return F.timestamp_micros(F.lit(BASE_MICROS) + F.pmod(F.col(key), F.lit(525600)) * 60_000_000)


def iso(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def json_object(**fields: Column) -> Column:
    """A JSON object; fields that are NULL are left out."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def dealt(rows: DataFrame) -> DataFrame:
    """Rows as the many files of a landing would deal them to tasks; the driver's tables are single files."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def land(rows: DataFrame, record: Column, *keep: str | Column, spread: bool = False) -> DataFrame:
    """The record of each row as its ``payload``, built once as if it had been read from a file.

    ``spread`` rows come from a shuffle, which has dealt them to tasks.
    """
    rows = rows.select(record.alias("_payload"), *keep)
    return once(rows if spread else dealt(rows), payload=F.col("_payload")).drop("_payload")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def paged(records: DataFrame, by: str | None = None, field: str = "results") -> DataFrame:
    """Pack ``item`` structs into listing pages of at most ``PAGE_SIZE``.

    Rows are packed where they are read, so no page grows with its listing.
    """
    groups = [F.floor(F.monotonically_increasing_id() / PAGE_SIZE).alias("page")]
    rows = records.select("*", *groups)
    keys = ["page"] if by is None else [by, "page"]
    return rows.groupBy(*keys).agg(F.collect_list("item").alias(field))


def contacts(t: Tables, edited: bool = False, typed: bool = False) -> DataFrame:
    """Customers as CRM records; ``edited`` is how they read after a later change of name.

    Here and below, ``typed`` adds the columns a typed landing has next to the payload.
    """
    changed = minutes_after_base("c_custkey")
    gone = F.col("c_acctbal") < 0
    name = F.concat("c_name", F.lit(" v2")) if edited else F.col("c_name")
    properties = F.struct(
        F.concat(F.lit("c"), text("c_custkey"), F.lit("@example.com")).alias("email"),
        F.lit("Customer").alias("firstname"), name.alias("lastname"),
        F.when(F.col("c_mktsegment") != "BUILDING", text("c_nationkey")).alias("phone"),
        F.col("c_mktsegment").alias("lifecyclestage"), iso(changed).alias("lastmodifieddate"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat_ws(
            ";", (F.col("c_custkey") + 1).cast("string"), F.lit(" "),
            F.concat(F.lit(" "), (F.col("c_custkey") + 2).cast("string")), (F.col("c_custkey") + 1).cast("string"))
               ).alias("hs_merged_object_ids"))
    return land(t.only("customer"), json_object(
        id=text("c_custkey"), createdAt=F.lit("2024-01-01T00:00:00Z"), updatedAt=iso(changed), archived=gone,
        archivedAt=F.when(gone, iso(changed)), properties=properties),
        *[text("c_custkey").alias("id"), changed.alias("modified"), gone.alias("archived"), F.when(gone, changed).alias("archived_at")] if typed else [])


def companies(t: Tables) -> DataFrame:
    properties = F.struct(
        F.col("s_name").alias("name"), F.concat(F.lit("s"), text("s_suppkey"), F.lit(".example.com")).alias("domain"),
        text("s_nationkey").alias("industry"))
    # the text "true" is not an archive flag
    return land(t.supplier, json_object(
        id=text("s_suppkey"), createdAt=F.lit("2024-01-01"), updatedAt=iso(minutes_after_base("s_suppkey")),
        archived=F.when(F.col("s_acctbal") < 5000, "true").otherwise("false"), properties=properties))


def deals(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("timestamp")
    gone = F.col("o_orderstatus") == "F"
    properties = F.struct(
        F.col("o_orderpriority").alias("dealname"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"),
        F.lit("USD").alias("deal_currency_code"), F.col("o_orderstatus").alias("dealstage"),
        F.lit("default").alias("pipeline"), F.unix_millis(day).cast("string").alias("closedate"),
        F.col("o_custkey").alias("hubspot_owner_id"))
    return land(t.only("orders"), json_object(
        id=text("o_orderkey"), createdAt=iso(day), updatedAt=iso(day), archived=gone,
        archivedAt=F.when(gone, iso(day)), properties=properties))


def issue_updated() -> Column:
    return F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
                               + F.pmod("o_orderkey", F.lit(86400)))


def issues(t: Tables, edited: bool = False, typed: bool = False) -> DataFrame:
    """Orders as issues, assigned to their customer; urgent ones have no reporter."""
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'"
    rows = t.only("orders").join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    summary = F.concat(F.lit("order "), text("o_orderkey"), F.lit(" v2" if edited else ""))
    fields = F.struct(
        summary.alias("summary"), F.struct(F.col("o_orderstatus").alias("name")).alias("status"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("priority"),
        F.struct(F.col("c_name").alias("displayName")).alias("assignee"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.struct(F.lit("Desk").alias("displayName"))).alias("reporter"),
        F.struct(F.lit("Order").alias("name")).alias("issuetype"), F.struct(F.lit("SALES").alias("key")).alias("project"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), stamp).alias("created"),
        F.date_format(issue_updated(), stamp).alias("updated"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("customfield_2"),
        F.when(F.col("o_orderstatus") == "P", F.struct(F.col("c_mktsegment").alias("value"))).alias("customfield_1"))
    return land(rows, json_object(key=F.concat(F.lit("ORD-"), text("o_orderkey")), fields=fields),
                *[issue_updated().alias("modified")] if typed else [])


def _quoted(column: Column) -> Column:
    return F.concat(F.lit('"'), column, F.lit('"'))


def pages(t: Tables, edited: bool = False, typed: bool = False) -> DataFrame:
    """Documents as workspace pages.

    Parents vary with the language; trash flags, titles and missing edit times
    with the source.
    """
    source, lang = F.col("source"), F.col("lang")
    parent = (F.when(lang == "en", F.concat(F.lit('{"type":"page_id","page_id":"p'), text("doc_id"), F.lit('"}')))
              .when(lang == "fr", F.lit('{"type":"workspace","workspace":true}'))
              .when(lang == "de", F.concat(F.lit('{"type":"data_source_id","database_id":"b'), text("doc_id"),
                                           F.lit('","data_source_id":"d'), text("doc_id"), F.lit('"}')))
              .otherwise("null"))
    trash = (F.when(source == "src1", '"in_trash":true')
             .when(source == "src2", '"archived":true')
             .when(source == "src3", '"in_trash":null,"archived":true')
             .otherwise('"in_trash":false,"archived":true'))
    suffix = " v2" if edited else ""
    title = (F.when(source == "src4", '{"Size":{"type":"number","number":1}}')
             .when(source == "src5", '{"Name":{"type":"title","title":[]}}')
             .otherwise(F.concat(
                 F.lit('{"Size":{"type":"number","number":'), text("n_chars"),
                 F.lit('},"Name":{"type":"title","title":[{"plain_text":'), _quoted(source),
                 F.lit('},{"href":null},{"plain_text":" '), lang, F.lit(suffix + '"}]}}'))))
    edit = F.when(source == "src7", "").otherwise(
        F.concat(F.lit('"last_edited_time":'), _quoted(iso(minutes_after_base("doc_id"))), F.lit(",")))
    record = F.concat(
        F.lit('{"object":"page","id":"p'), text("doc_id"), F.lit('","created_time":"2024-01-01T00:00:00.000Z",'), edit,
        F.lit('"created_by":{"object":"user","id":"u1"},"last_edited_by":{"object":"user","id":'), _quoted(source),
        F.lit('},'), trash, F.lit(',"parent":'), parent, F.lit(',"url":"https://ws.example.com/p'), text("doc_id"),
        F.lit('","public_url":null,"properties":'), title, F.lit("}"))
    edited_at = F.when(source != "src7", minutes_after_base("doc_id"))
    return land(t.only("documents", "doc_id", "source", "lang", "n_chars"), record,
                *[F.lit("page").alias("kind"), edited_at.alias("edited")] if typed else [])


def data_sources(t: Tables) -> DataFrame:
    title = F.when(F.col("n_regionkey") > 0, F.array(
        F.struct(F.col("n_name").alias("plain_text")), F.struct(F.lit("!").alias("plain_text"))))
    return land(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), json_object(
        object=F.lit("data_source"), id=text("n_nationkey"), created_time=F.lit("2024-01-01"),
        last_edited_time=F.lit("2024-01-02T00:00:00Z"), in_trash=F.lit(False),
        parent=F.struct(F.lit("database_id").alias("type"), F.col("r_name").alias("database_id")),
        url=F.concat(F.lit("https://ws.example.com/"), F.col("n_name")), title=title))


def blocks(t: Tables, has_children: bool = False) -> DataFrame:
    """Conversation turns as blocks whose body sits under the name of their type."""
    body = F.to_json(F.create_map("role", F.struct(F.array(F.struct(F.col("text").alias("plain_text"))).alias("rich_text"))))
    record = F.concat(
        F.lit('{"object":"block","id":"'), text("conv_id"), F.lit("-"), text("turn"), F.lit('","type":"'), F.col("role"),
        F.lit(f'","has_children":{str(has_children).lower()},"in_trash":false,"last_edited_time":"'),
        iso(minutes_after_base("turn")), F.lit('","parent":{"type":"page_id","page_id":"'), text("conv_id"), F.lit('"},'),
        F.substr(body, F.lit(2)))
    return land(t.only("conversations"), record, text("conv_id").alias("page_id"), F.lit(0).alias("depth"),
                F.col("turn").cast("int").alias("position"), "conv_id", "turn", "role")


def users(t: Tables) -> DataFrame:
    bot = F.col("c_mktsegment") == "MACHINERY"
    return land(t.customer, json_object(
        object=F.lit("user"), id=text("c_custkey"), type=F.when(bot, "bot").otherwise("person"), name=F.col("c_name"),
        avatar_url=F.when(F.col("c_acctbal") > 0, F.concat(F.lit("https://img.example.com/"), text("c_custkey"))),
        person=F.when(~bot, F.struct(F.concat(text("c_custkey"), F.lit("@example.com")).alias("email")))))


def link_pages(t: Tables, to: str) -> DataFrame:
    """Order to part (or supplier) links, two kinds each, in continuation pages per order."""
    def target(line: Column) -> Column:
        number = line["number"].cast("string")
        kinds = F.concat(
            F.lit('[{"category":"A","typeId":'), number, F.lit('.5,"label":null},{"category":"B","typeId":"'),
            F.when(line["flag"] == "A", "x").otherwise(number), F.lit('","label":'), _quoted(line["flag"]), F.lit("}]"))
        return F.concat(F.lit('{"toObjectId":'), line["to"].cast("string"), F.lit(',"associationTypes":'), kinds, F.lit("}"))

    # lines meet as they are read and are spelled on their page, so no JSON is shuffled
    line = F.struct(F.col(to).alias("to"), F.col("l_linenumber").alias("number"), F.col("l_returnflag").alias("flag"))
    pages = paged(t.only("lineitem").select("l_orderkey", line.alias("item")), by="l_orderkey", field="lines")
    return land(pages, F.concat(
        F.lit('{"results":[{"from":{"id":"'), text("l_orderkey"), F.lit('"},"to":['),
        F.array_join(F.transform("lines", target), ","), F.lit("]}]}")), spread=True)


def documents(t: Tables, extra: bool = False) -> DataFrame:
    """Line items as nested documents; ``extra`` adds a field the first schema did not have."""
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int"))
    fields = dict(
        _id=key, order_no=F.col("l_orderkey"), shipped=iso(F.col("l_shipdate").cast("timestamp")),
        price=F.col("l_extendedprice").cast("decimal(18,2)"),
        line=F.struct(F.col("l_linenumber").alias("number"), F.col("l_quantity").cast("decimal(9,1)").alias("quantity")),
        flags=F.array("l_returnflag", "l_linestatus"))
    if extra:
        fields["added"] = F.lit(1)
    # a number in some documents, text in others
    mixed = F.when(F.col("l_returnflag") == "N", '"N"').otherwise(text("l_linenumber"))
    record = F.concat(F.lit('{"mixed":'), mixed, F.lit(","), F.substr(json_object(**fields), F.lit(2)))
    return land(t.only("lineitem"), record, "l_shipdate", "l_linestatus", F.col("l_shipdate").cast("timestamp").alias("modified"))
