"""Whether landed listing pages form whole chains.

A page has the cursor it answers (``asked``, null for the first page of a
listing), the cursor of the page after it (``token``) and, if the source says
so, ``is_last``. Pages land in any order and a listing may hold most of them,
so a chain is not followed page by page: every page finds its place by pointer
jumping, in as many joins as the longest chain has binary digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.operators.quality import paging_faults
from lakesync.session import Scratch

FIRST, NEXT, BEFORE, LAST = "first page not landed", "page not landed", "page before not landed", "last page not landed"
ENDS, TWICE, ANSWERS, LOOP = "more than one last page", "cursor named twice", "page answered differently", "loop"

# Cursors as node names: the first page has no cursor, and a cursor may be any text.
_HEAD = ""


def _named(column: str):
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(_HEAD))


def _nodes(pages: DataFrame, listing: str) -> DataFrame:
    """``listing, node, next, answers``: one row per page, landed once or again; ``next`` is null on a last page."""
    last = F.coalesce(F.col("is_last"), F.lit(False)) if "is_last" in pages.columns else F.lit(False)
    after = F.when(~last & F.col("token").isNotNull(), _named("token"))
    answers = pages.select(F.col(listing).alias("listing"), _named("asked").alias("node"), after.alias("next")).distinct()
    # of different answers the one that goes on, so that what follows is still looked at
    return answers.groupBy("listing", "node").agg(F.min("next").alias("next"), F.count(F.lit(1)).alias("answers"))


def _named_by(nodes: DataFrame) -> DataFrame:
    """``listing, node, before, names``: the pages that name a cursor."""
    return nodes.where("next IS NOT NULL").groupBy("listing", F.col("next").alias("node")).agg(
        F.min("node").alias("before"), F.count(F.lit(1)).alias("names"))


def _ranked(nodes: DataFrame, named: DataFrame, scratch: Scratch) -> DataFrame:
    """``listing, node, head, place, least``: the first page of the run of pages a page belongs to, and its place there.

    A cursor that several pages name begins a run of its own. Every page points
    at one before it, and after each round at one twice as far; no two pages
    point at the same one before they have reached their head, so no key is hot.
    Pages still without a head after the last round go round in a loop, whose
    least cursor is ``least``; their ``head`` is null.
    """
    before = named.where("names = 1").select("listing", "node", "before")
    linked = nodes.select("listing", "node").join(before, ["listing", "node"], "left")
    state = scratch.cut(linked.select(
        "listing", "node", F.coalesce("before", "node").alias("at"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("place"),
        F.col("before").isNull().alias("done"), F.least("node", "before").alias("least")))
    longest = state.groupBy("listing").count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest.bit_length()):
        if state.where("NOT done").isEmpty():
            break
        reached = state.select("listing", F.col("node").alias("at"), F.col("at").alias("_at"), F.col("place").alias("_place"),
                               F.col("done").alias("_done"), F.col("least").alias("_least"))
        jumped = state.where("NOT done").join(reached, ["listing", "at"]).select(
            "listing", "node", F.col("_at").alias("at"), (F.col("place") + F.col("_place")).alias("place"), F.col("_done").alias("done"),
            F.least("least", "_least").alias("least"))
        following = scratch.cut(jumped.unionByName(state.where("done")))
        scratch.drop(state)
        state = following
    done = F.col("done")
    return state.select("listing", "node", F.when(done, F.col("at")).alias("head"), F.when(done, F.col("place")).alias("place"), "least")


def _cursor(column: str):
    return F.when(F.col(column) != _HEAD, F.substr(column, F.lit(2)))


def page_places(pages: DataFrame, listing: str = "listing", scratch: Scratch | None = None) -> DataFrame:
    """``listing, asked, run, place`` of every page: its place (from 0) in a run of pages that name each other.

    ``run`` is the cursor of the run's first page, null for the run that begins
    with the listing's first page; a whole listing is one such run. Pages of a
    loop have no place.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    nodes = scratch.cut(_nodes(pages, listing))
    ranked = _ranked(nodes, _named_by(nodes), scratch)
    return ranked.select("listing", _cursor("node").alias("asked"), _cursor("head").alias("run"), "place")


def chain_faults(pages: DataFrame, listing: str = "listing", tolerated: Sequence[str] = (), scratch: Scratch | None = None) -> DataFrame:
    """``listing, fault, cursor``: what keeps the pages of a listing from being one whole chain; no rows if nothing does.

    A lost page is named by the cursor it would have answered and, where the
    pages after it were landed, by the cursor of the next one. A listing
    without any last page whose only open end is one cursor has lost the page
    of that cursor; with several open ends (or none) the cursor is null.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    nodes = scratch.cut(_nodes(pages, listing))
    named = scratch.cut(_named_by(nodes))
    ranked = _ranked(nodes, named, scratch)
    key = ["listing", "node"]
    first = nodes.groupBy("listing").agg(F.max(F.col("node") == _HEAD).alias("_first"))
    open_ends = named.join(nodes, key, "left_anti").select(*key)
    ends = nodes.groupBy("listing").agg(F.count_if(F.col("next").isNull()).alias("_ends"))
    counted = ends.join(open_ends.groupBy("listing").agg(F.count(F.lit(1)).alias("_open"), F.min("node").alias("_one")), "listing", "left")
    lost_last = counted.where("_ends = 0").select("listing", F.lit(LAST).alias("fault"), F.when(F.col("_open") == 1, F.col("_one")).alias("node"))
    found = (first.where("NOT _first").select("listing", F.lit(FIRST).alias("fault"), F.lit(None).cast("string").alias("node"))
             .unionByName(open_ends.join(lost_last.select(*key), key, "left_anti").select("listing", F.lit(NEXT).alias("fault"), "node"))
             .unionByName(nodes.where(F.col("node") != _HEAD).join(named, key, "left_anti").select("listing", F.lit(BEFORE).alias("fault"), "node"))
             .unionByName(lost_last)
             .unionByName(counted.where("_ends > 1").select("listing", F.lit(ENDS).alias("fault"), F.lit(None).cast("string").alias("node")))
             .unionByName(named.where("names > 1").select("listing", F.lit(TWICE).alias("fault"), "node"))
             .unionByName(nodes.where("answers > 1").select("listing", F.lit(ANSWERS).alias("fault"), "node"))
             .unionByName(ranked.where("head IS NULL").select("listing", F.lit(LOOP).alias("fault"), F.col("least").alias("node")).distinct()))
    kept = found.where(~F.col("fault").isin(*tolerated)) if tolerated else found
    return kept.select("listing", "fault", _cursor("node").alias("cursor"))


def incomplete_listings(pages: DataFrame, tolerated: Sequence[str] = ()) -> DataFrame:
    """Faults of landed pages, for a job's gate: of their chains if they landed with the cursor they answer."""
    if "asked" in pages.columns:
        return chain_faults(pages, tolerated=tolerated)
    return paging_faults(pages, "listing", strict=True).where("status != 'ok'")
