"""Users, data sources, pages and page content, with their sync state."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.functions.payload import RECORD, with_record
from lakesync.mapping.workspace import block_rows, data_source_rows, in_trash, page_rows, user_rows
from lakesync.operators.dedup import newest
from lakesync.operators.paging import TWICE, incomplete_listings
from lakesync.operators.tree import page_blocks
from lakesync.operators.windows import from_micros, open_ended
from lakesync.plans.ledger import Ledger, Step
from lakesync.plans.run import Change, run_objects, selected, started, wants_full
from lakesync.plans.store import SEQ, TableStore
from lakesync.schemas import BLOCKS, DATA_SOURCES, PAGES, USERS, WORKSPACE_STATE, WORKSPACE_TABLES
from lakesync.session import Scratch
from lakesync.sources.listing import changes_since

OBJECTS = tuple(WORKSPACE_TABLES)
# A cursor that comes again ends these listings.
TOLERATED_PAGING = (TWICE,)


@dataclass(frozen=True)
class WorkspaceLanding:
    """Landed payloads. ``children`` is one row per listed block: ``parent_id``, ``seq``, ``payload``, and ``landing`` if
    lists land repeatedly. ``unreadable`` holds the ``page_id`` of pages whose content could not be read, ``listed`` the
    ``parent_id`` of every child list that was landed, empty ones included; with it a page that lacks its list fails
    the blocks instead of losing them. ``feeds`` are the listing pages per object (``listing``, ``asked``, ``token``; pages
    and blocks share those of ``pages``): one that is missing from its chain fails the object."""

    users: DataFrame | None = None
    data_sources: DataFrame | None = None
    pages: DataFrame | None = None
    children: DataFrame | None = None
    unreadable: DataFrame | None = None
    listed: DataFrame | None = None
    feeds: Mapping[str, DataFrame] = field(default_factory=dict)


def page_refs(pages: DataFrame) -> DataFrame:
    """Newest reference per page (``id``, ``edited``, ``in_trash``) of a discovery feed."""
    keep = [c for c in (SEQ,) if c in pages.columns]
    refs = with_record(pages).select(F.get_json_object("payload", "$.id").alias("id"), "edited", in_trash(F.col(RECORD)).alias("in_trash"), *keep)
    return newest(refs, ["id"], "edited", keep).drop(*keep)


def page_outcome(refs: DataFrame, unreadable: DataFrame | None) -> DataFrame:
    """``page_id, outcome`` of every reference: trashed, skipped (not readable) or walked."""
    pages = refs.select(F.col("id").alias("page_id"), "in_trash")
    if unreadable is None:
        pages = pages.withColumn("_closed", F.lit(None).cast("boolean"))
    else:
        pages = pages.join(unreadable.select("page_id", F.lit(True).alias("_closed")).distinct(), "page_id", "left")
    outcome = F.when(F.col("in_trash"), "trashed").when(F.col("_closed"), "skipped").otherwise("walked")
    return pages.select("page_id", outcome.alias("outcome"))


def readable_pages(refs: DataFrame, unreadable: DataFrame | None) -> DataFrame:
    """Pages to walk: not in the trash, content readable."""
    return page_outcome(refs, unreadable).where("outcome = 'walked'").select("page_id")


def skipped_pages(refs: DataFrame, unreadable: DataFrame) -> DataFrame:
    return page_outcome(refs, unreadable).where("outcome = 'skipped'").select("page_id")


def object_change(spec, mapped: Callable[..., DataFrame], feed: DataFrame, run_at: datetime, whole: bool, **more) -> Change:
    """Mapped rows of a feed, replacing the table or merged into it."""
    return Change(spec, mapped(feed, run_at, [c for c in (SEQ,) if c in feed.columns]), whole=whole, **more)


def block_change(refs: DataFrame, landing: WorkspaceLanding, run_at: datetime, whole: bool) -> Change:
    """Content of the changed pages: walked anew if readable, cleared if trashed or no longer readable."""
    roots = readable_pages(refs, landing.unreadable)
    stamp = "landing" if "landing" in landing.children.columns else None
    rows = block_rows(page_blocks(roots, landing.children, [SEQ], stamp), run_at)
    gates = {}
    if landing.listed is not None:
        unlisted = roots.join(landing.listed.select(F.col("parent_id").alias("page_id")), "page_id", "left_anti")
        gates["child lists of pages were not landed"] = unlisted

    def skipped() -> str | None:
        count = 0 if landing.unreadable is None else skipped_pages(refs, landing.unreadable).count()
        return f"{count} unreadable pages cleared" if count else None

    return Change(BLOCKS, rows, whole=whole, parents=None if whole else refs.select(F.col("id").alias("page_id")), gates=gates, note=skipped,
                  reached=lambda _: from_micros(refs.agg(F.max(F.unix_micros("edited"))).first()[0]))


def workspace_changes(landing: WorkspaceLanding, plan: Mapping[str, Step], overlap: timedelta, run_at: datetime,
                      scratch: Scratch) -> dict[str, Callable[[Step], Change]]:
    """How each object changes from its step of the plan."""

    def since(step: Step) -> datetime | None:
        return None if step.mode == "full" else step.watermark - overlap

    @cache
    def discovered() -> DataFrame:
        """One change feed for pages and blocks, back to the earlier of their thresholds, written once."""
        bounds = [since(plan[name]) for name in ("pages", "blocks") if name in plan]
        return scratch.cut(changes_since(landing.pages, "page", None if None in bounds else min(bounds)).drop(RECORD))

    def users(step: Step) -> Change:
        return object_change(USERS, user_rows, landing.users, run_at, True, reached=lambda _: None)

    def data_sources(step: Step) -> Change:
        return object_change(DATA_SOURCES, data_source_rows, changes_since(landing.data_sources, "data_source", since(step)), run_at, step.mode == "full")

    def pages(step: Step) -> Change:
        feed, whole = open_ended(discovered(), "edited", since(step)), step.mode == "full"
        return object_change(PAGES, page_rows, feed, run_at, whole, note=lambda: "no page is visible" if whole and feed.isEmpty() else None)

    def blocks(step: Step) -> Change:
        refs = scratch.cut(open_ended(page_refs(discovered()), "edited", since(step)))
        return block_change(refs, landing, run_at, step.mode == "full")

    def gated(name: str, change: Callable[[Step], Change]) -> Callable[[Step], Change]:
        listed = landing.feeds.get("pages" if name == "blocks" else name)
        if listed is None:
            return change

        def build(step: Step) -> Change:
            made = change(step)
            return replace(made, gates={f"{name} listings are not complete": incomplete_listings(listed, TOLERATED_PAGING), **made.gates})

        return build

    changes = {"users": users, "data_sources": data_sources, "pages": pages, "blocks": blocks}
    return {name: gated(name, change) for name, change in changes.items()}


def sync_workspace(store: TableStore, landing: WorkspaceLanding, objects: Sequence[str] = OBJECTS,
                   mode: str | None = None, overlap_seconds: int = 300, now: datetime | None = None) -> DataFrame:
    """Sync the objects and return the report.

    The next watermark is the newest edit seen, or the stored one when nothing changed.
    """
    full, run_at, scratch = wants_full(mode, "cdc"), started(now), Scratch(store.spark)
    store.ensure_schema()
    ledger = Ledger(store, WORKSPACE_STATE)
    plan = ledger.plan(selected(OBJECTS, objects), full, always_full=["users"], changed="cdc")
    try:
        return run_objects(store, ledger, plan, workspace_changes(landing, plan, timedelta(seconds=overlap_seconds), run_at, scratch), run_at)
    finally:
        scratch.drop_all()
