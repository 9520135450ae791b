"""CRM records and links."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.functions.payload import RECORD, canonical, each, is_true, text_at, with_record
from lakesync.functions.times import to_time
from lakesync.functions.values import id_list, to_amount, type_id
from lakesync.operators.windows import instant
from lakesync.schemas import ASSOCIATIONS, CRM_TABLES

# Source property behind each column, and the property holding the change time.
PROPERTIES = {
    "contacts": {"email": "email", "first_name": "firstname", "last_name": "lastname", "phone": "phone",
                 "lifecycle_stage": "lifecyclestage"},
    "companies": {"name": "name", "domain": "domain", "industry": "industry"},
    "deals": {"deal_name": "dealname", "amount": "amount", "currency": "deal_currency_code",
              "deal_stage": "dealstage", "pipeline": "pipeline", "close_date": "closedate",
              "owner_id": "hubspot_owner_id"},
}
MODIFIED = {"contacts": "lastmodifieddate", "companies": "hs_lastmodifieddate", "deals": "hs_lastmodifieddate"}
MERGED_IDS = "hs_merged_object_ids"
LINK_PAIRS = (("contacts", "companies"), ("deals", "contacts"), ("deals", "companies"))
_READERS = {"amount": to_amount, "close_date": to_time}

_LINK_PAGE = (
    "results array<struct<`from`:struct<id:string>,"
    "`to`:array<struct<toObjectId:string,associationTypes:array<struct<"
    "typeId:variant,category:string,label:string>>>>,paging:struct<next:struct<after:string>>>>"
)


def object_rows(records: DataFrame, kind: str, run_at: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """One row per contact, company or deal."""
    record = F.col(RECORD)
    archived = is_true(record, "archived")
    columns: dict[str, Column] = {
        "id": text_at(record, "id"),
        "created_at": to_time(text_at(record, "createdAt")),
        "updated_at": to_time(text_at(record, "updatedAt")),
        "archived": archived,
        "archived_at": F.when(archived, to_time(text_at(record, "archivedAt"))),
        "raw_json": canonical(record),
        "_ingested_at": instant(run_at),
    }
    for column, name in PROPERTIES[kind].items():
        text = text_at(record, "properties." + name)
        columns[column] = _READERS[column](text) if column in _READERS else text
    return with_record(records).select(*[columns[name].alias(name) for name in CRM_TABLES[kind].names], *keep)


def merged_away(records: DataFrame) -> DataFrame:
    """Ids that were merged into another record and no longer exist on their own."""
    ids = id_list(F.get_json_object("payload", "$.properties." + MERGED_IDS))
    return each(records, ids, item="id")


def link_rows(pages: DataFrame, from_object: str | Column, to_object: str | Column, run_at: datetime) -> DataFrame:
    """One row per (from, to, link type) of the landed link pages, continuation pages included.

    The two ends are names, or columns of ``pages`` where pages of several pairs come together.
    """
    ends = [(F.lit(end) if isinstance(end, str) else end).alias(name) for name, end in (("from_object", from_object), ("to_object", to_object))]
    inputs = each(pages, F.from_json("payload", _LINK_PAGE)["results"], ends, item="input")
    targets = each(inputs, F.col("input.to"), ["from_object", "to_object", F.col("input.from.id").alias("from_id")], item="target")
    kinds = each(targets, F.col("target.associationTypes"),
                 ["from_object", "to_object", "from_id", F.col("target.toObjectId").alias("to_id")], item="kind")
    return kinds.select(
        "from_object", "from_id", "to_object", "to_id",
        type_id(F.col("kind.typeId")).alias("association_type_id"), "kind.category", "kind.label",
        instant(run_at).alias("_ingested_at"),
    ).select(*ASSOCIATIONS.names)


def open_cursors(pages: DataFrame) -> DataFrame:
    """``from_object, to_object, from_id, cursor`` of inputs whose links go on at a cursor nothing was landed for.

    A landed page says in ``cursor`` which one it answers; first pages have none. Answered cursors are as many as
    pages, whatever size Spark takes parsed rows for, so they are not broadcast.
    """
    names = [name for name in ("from_object", "to_object") if name in pages.columns]
    asked = F.col("cursor") if "cursor" in pages.columns else F.lit(None).cast("string")
    inputs = each(pages, F.from_json("payload", _LINK_PAGE)["results"], [*names, asked.alias("_asked")], item="input")
    inputs = inputs.select(*names, F.col("input.from.id").alias("from_id"), "_asked", F.col("input.paging.next.after").alias("cursor"))
    landed = inputs.where("_asked IS NOT NULL").select(*names, "from_id", F.col("_asked").alias("cursor"))
    return inputs.where("cursor != ''").select(*names, "from_id", "cursor").join(landed.hint("merge"), [*names, "from_id", "cursor"], "left_anti")
