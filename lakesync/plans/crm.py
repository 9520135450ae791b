"""Contacts, companies and deals, the links between them, and their sync state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.mapping.crm import LINK_PAIRS, link_rows, merged_away, object_rows, open_cursors
from lakesync.operators.paging import TWICE, incomplete_listings
from lakesync.operators.quality import untolerated_errors
from lakesync.operators.windows import half_open, instant
from lakesync.plans.ledger import Ledger, Step
from lakesync.plans.run import Change, run_objects, selected, started, wants_full
from lakesync.plans.store import SEQ, TableStore
from lakesync.schemas import ASSOCIATIONS, CRM_STATE, CRM_TABLES
from lakesync.sources.landing import typed_records
from lakesync.sources.listing import live_ids

LINKS = "associations"
OBJECTS = (*CRM_TABLES, LINKS)
# Categories of partial errors that mean nothing is missing.
TOLERATED_RECORDS = ("OBJECT_NOT_FOUND",)
TOLERATED_LINKS = ("NO_ASSOCIATIONS_FOUND", "OBJECT_NOT_FOUND")
# A cursor that comes again ends these listings.
TOLERATED_PAGING = (TWICE,)


@dataclass(frozen=True)
class CrmLanding:
    """Landed payloads: all records per object, live and archived, and link pages per object pair.

    ``answers`` are the raw answers the records came in, if they were landed:
    an error in one that is not tolerated fails the object. ``pages`` are the
    listing pages per object (``listing``, ``asked``, ``token``): one that is
    missing from its chain fails the object.
    """

    records: Mapping[str, DataFrame]
    links: Mapping[tuple[str, str], DataFrame] = field(default_factory=dict)
    answers: Mapping[str, DataFrame] = field(default_factory=dict)
    pages: Mapping[str, DataFrame] = field(default_factory=dict)


def modified_records(records: DataFrame, kind: str, since: datetime, until: datetime,
                     overlap_seconds: int = 300) -> DataFrame:
    """Live records changed in ``[since - overlap, until)``; on landed typed columns this reaches the scan."""
    typed = typed_records(records, kind)
    return half_open(typed.where("NOT archived"), "modified", since, until, overlap_seconds)


def record_change(records: DataFrame, kind: str, since: datetime | None, run_at: datetime,
                  overlap_seconds: int = 300, answers: DataFrame | None = None,
                  pages: DataFrame | None = None) -> Change:
    """All records, or from ``since`` the changed ones with the ids that are archived or were merged away.

    Archived ids come with their time, merged-away ones with the run's.
    """
    spec, keep = CRM_TABLES[kind], [c for c in (SEQ,) if c in records.columns]
    gates = {} if answers is None else {f"{kind} were not all answered": untolerated_errors(answers, TOLERATED_RECORDS)}
    if pages is not None:
        gates[f"{kind} listings are not complete"] = incomplete_listings(pages, TOLERATED_PAGING)
    if since is None:
        return Change(spec, object_rows(records, kind, run_at, keep), whole=True, gates=gates, reached=lambda _: run_at)
    typed = typed_records(records, kind)
    changed = modified_records(typed, kind, since, run_at, overlap_seconds)
    archived = typed.where("archived").select("id", "archived_at")
    marks = archived.unionByName(merged_away(changed).withColumn("archived_at", instant(run_at)))
    return Change(spec, object_rows(changed, kind, run_at, keep), marks=marks, gates=gates, reached=lambda _: run_at)


def pair_status(spark, picked: Sequence[str], tables: Sequence[str]) -> DataFrame:
    """``from_object, to_object, status`` of every pair: read, not selected, or without a source table."""
    known = spark.createDataFrame(list(LINK_PAIRS), "from_object string, to_object string")
    status = (F.when(~F.col("from_object").isin(*picked), "not selected")
              .when(~F.col("from_object").isin(*tables) if tables else F.lit(True), "no source table").otherwise("read"))
    return known.withColumn("status", status)


def link_change(store: TableStore, landing: CrmLanding, picked: Sequence[str], run_at: datetime) -> Change:
    """Links of all live source records, over one frame of all pairs.

    The result replaces the table only if every pair was read. A pair whose
    source table is missing fails the object, after the others are merged.
    """
    tables = [name for name in CRM_TABLES if store.exists(name)]
    status = [tuple(row) for row in pair_status(store.spark, picked, tables).collect()]  # one row per pair
    pairs = [(a, b) for a, b, state in status if state == "read"]
    lacking = ", ".join(f"{a}->{b}" for a, b, state in status if state == "no source table")
    empty = store.spark.createDataFrame([], "payload string, cursor string, from_object string, to_object string")
    pages = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), [
        landing.links[pair].select(*[c for c in ("payload", "cursor") if c in landing.links[pair].columns],
                                   F.lit(pair[0]).alias("from_object"), F.lit(pair[1]).alias("to_object")) for pair in pairs], empty)
    nobody = store.spark.createDataFrame([], "from_object string, from_id string")
    sources = reduce(DataFrame.unionByName, [
        live_ids(store.read(name)).select(F.lit(name).alias("from_object"), F.col("id").alias("from_id"))
        for name in sorted({a for a, _ in pairs})], nobody)
    rows = link_rows(pages, F.col("from_object"), F.col("to_object"), run_at)
    rows = rows.join(sources.distinct(), ["from_object", "from_id"], "left_semi").select(*ASSOCIATIONS.names)
    return Change(
        ASSOCIATIONS, rows, whole=len(pairs) == len(LINK_PAIRS), reached=lambda _: run_at,
        gates={"link pages were not all landed": open_cursors(pages),
               "links were not all answered": untolerated_errors(pages, TOLERATED_LINKS)},
        lacking=f"no source table for {lacking}" if lacking else "")


def sync_crm(store: TableStore, landing: CrmLanding, objects: Sequence[str] = OBJECTS, mode: str | None = None,
             overlap_seconds: int = 300, now: datetime | None = None) -> DataFrame:
    """Sync the objects and return the report; the next watermark is the run start."""
    full, run_at = wants_full(mode), started(now)
    store.ensure_schema()
    ledger, picked = Ledger(store, CRM_STATE), selected(OBJECTS, objects)
    plan = ledger.plan(picked, full, always_full=[LINKS], always_note="all links are read on every run")

    def records(kind: str, step: Step) -> Change:
        since = step.watermark if step.mode == "incremental" else None
        return record_change(landing.records[kind], kind, since, run_at, overlap_seconds, landing.answers.get(kind), landing.pages.get(kind))

    changes = {kind: partial(records, kind) for kind in CRM_TABLES}
    changes[LINKS] = lambda step: link_change(store, landing, picked, run_at)
    return run_objects(store, ledger, plan, changes, run_at)


def deals_by_stage(deals: DataFrame) -> DataFrame:
    """Live deals and their amount per stage."""
    return (deals.filter("NOT archived").groupBy("deal_stage")
            .agg(F.count(F.lit(1)).alias("n_deals"), F.sum("amount").alias("amount")))


def linked_names(links: DataFrame, sources: DataFrame, targets: DataFrame, source_name: str,
                 target_name: str) -> DataFrame:
    """Link traversal: one row per link with the names at both ends.

    Spark takes links parsed from pages for far fewer bytes than they have, and would broadcast them.
    """
    left = sources.select(F.col("id").alias("from_id"), F.col(source_name).alias("from_name"))
    right = targets.select(F.col("id").alias("to_id"), F.col(target_name).alias("to_name"))
    return links.select("from_id", "to_id").hint("merge").join(left, "from_id").join(right, "to_id")
