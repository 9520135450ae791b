"""Depth-first walk of a forest given as child lists.

Input is one row per child: ``parent_id``, ordering columns, and the child's
JSON ``payload``. Output is one row per (page, block) with ``depth``,
``position`` and ``path``; sorting by ``path`` gives reading order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.functions.payload import RECORD, node_at, text_at, truthy, with_record
from lakesync.operators.ranking import ordered_index
from lakesync.session import Scratch

# Content of these belongs to another page or data source.
NEVER_DESCEND = ("child_page", "child_database")


def descends(record: Column) -> Column:
    """Whether the walk goes below this block: it has children of its own to show."""
    kind = text_at(record, "type")
    reference = (kind == "synced_block") & truthy(node_at(record, "synced_block.synced_from"))
    barred = F.coalesce(kind.isin(*NEVER_DESCEND) | reference, F.lit(False))
    return truthy(node_at(record, "has_children")) & ~barred


def latest_lists(children: DataFrame, landing: str) -> DataFrame:
    """Of parents whose child list was landed more than once, the list of the newest landing alone.

    One value per parent is shuffled; the lists themselves are only filtered.
    """
    newest = children.groupBy(F.col("parent_id").alias("_parent")).agg(F.max(landing).alias("_newest"))
    same = (F.col("parent_id") == F.col("_parent")) & F.col(landing).eqNullSafe(F.col("_newest"))
    return children.join(newest, same, "left_semi")


def numbered_children(children: DataFrame, order_by: Sequence[str], scratch: Scratch) -> DataFrame:
    """Child rows written once: ``edge`` (a number of their own), ``parent_id``, ``id``, ``position``, ``descend``, ``payload``.

    Positions count every listed child, repeated ones and those without an
    ordering value included; equal ordering values go by id.
    """
    record = F.col(RECORD)
    parsed = with_record(children).select(
        "parent_id", *order_by, "payload", text_at(record, "id").alias("id"), descends(record).alias("descend"))
    placed = ordered_index(parsed, [*order_by, "id"], within=["parent_id"], number="edge", scratch=scratch)
    return scratch.cut(placed.withColumn("position", F.col("position").cast("int")))


def walk(roots: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Every block reachable from each ``page_id`` of ``roots``, once per page: its ``edge``, ``depth`` and ``path``.

    A block listed more than once keeps its first place in reading order, which
    is its smallest path. Blocks listed once have one way up, whatever its
    length: each finds the nearest page or repeated block above it by pointer
    jumping, in as many joins as the longest way has binary digits. Only
    repeated blocks (and what is below a page that is listed as a block) are
    walked level by level, over edges that span the ways between them.
    """
    pages = roots.select(F.col("page_id").alias("top")).where("top IS NOT NULL").distinct()
    repeated = edges.groupBy(F.col("id").alias("top")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR top IS NULL").select("top")
    tops = scratch.cut(pages.unionByName(repeated).distinct())
    listed_tops = edges.join(tops, edges["id"].eqNullSafe(tops["top"]), "left_semi")
    single = edges.join(tops, edges["id"].eqNullSafe(tops["top"]), "left_anti")
    ways = _ways(single, tops, scratch)
    starts = roots.select("page_id", F.col("page_id").alias("top"), F.array().cast("array<int>").alias("_path")).distinct()
    if listed_tops.isEmpty():
        return _below(ways, starts).withColumn("depth", F.size("path") - 1)
    # below a page that is itself a block that is gone into, a block may have two places on one page
    both = scratch.cut(listed_tops.where("descend").select(F.col("id").alias("top")).join(pages, "top", "left_semi").distinct())
    knotted = ways.join(both, "top", "left_semi")
    links = scratch.cut(_links(listed_tops, ways.join(both, "top", "left_anti"), tops).unionByName(
        _links(listed_tops, knotted.select(F.col("id").alias("top")), None)).unionByName(
        knotted.select(F.col("parent_id").alias("_at"), "id", "parent_id", "position", "descend", "edge", F.array("position").alias("piece"))))
    reached = _levels(roots, links, scratch)
    places = starts.unionByName(reached.where("descend").select("page_id", F.col("id").alias("top"), F.col("path").alias("_path")))
    return reached.unionByName(_below(ways.join(both, "top", "left_anti"), places)).withColumn("depth", F.size("path") - 1)


def _below(ways: DataFrame, places: DataFrame) -> DataFrame:
    return ways.join(places, "top").select(
        "page_id", "id", "parent_id", "position", "descend", "edge", F.concat("_path", "piece").alias("path"))


def _ways(single: DataFrame, tops: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks listed once with ``top``, the nearest top above them, and ``piece``, the positions from there; without a top they go.

    A block points at its parent, and after each round twice as far up.
    """
    up = tops.select(F.col("top").alias("at"), F.lit(True).alias("_found"))
    state = scratch.cut(single.withColumn("at", F.col("parent_id")).withColumn("piece", F.array("position"))
                        .join(up, "at", "left").withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found"))
    for _ in range(max(1, state.count().bit_length())):
        if state.where("NOT found").isEmpty():
            break
        above = state.where("descend").select(F.col("id").alias("at"), F.col("at").alias("_at"), F.col("piece").alias("_piece"), F.col("found").alias("_found"))
        jumped = state.where("NOT found").join(above, "at").withColumns(
            {"at": F.col("_at"), "piece": F.concat("_piece", "piece"), "found": F.col("_found")}).select(*state.columns)
        following = scratch.cut(state.where("found").unionByName(jumped))
        scratch.drop(state)
        state = following
    return state.where("found").withColumnRenamed("at", "top").drop("found")


def _links(listed: DataFrame, ways: DataFrame, tops: DataFrame | None) -> DataFrame:
    """Edges between tops: ``piece`` are the positions from the top ``_at`` to a listed block.

    The way goes over a block with a top; with ``tops`` also straight from one.
    """
    names = ["id", "parent_id", "position", "descend", "edge"]
    if "piece" not in ways.columns:  # blocks that are tops now
        return listed.join(ways, listed["parent_id"] == ways["top"], "left_semi").select(
            F.col("parent_id").alias("_at"), *names, F.array("position").alias("piece"))
    over = ways.where("descend").select(F.col("id").alias("_over"), F.col("top").alias("_at"), F.col("piece").alias("_piece"))
    far = listed.join(over, listed["parent_id"] == over["_over"]).select("_at", *names, F.concat("_piece", F.array("position")).alias("piece"))
    near = listed.join(tops, listed["parent_id"] == tops["top"], "left_semi")
    return far.unionByName(near.select(F.col("parent_id").alias("_at"), *names, F.array("position").alias("piece")))


def _levels(roots: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The blocks that links lead to, level by level from each page, each at its smallest path.

    A place with a larger path than one already found is not followed, so every
    walk ends, also where a block is its own ancestor or lists its page.
    """
    key = ["page_id", "id"]

    def next_level(frontier: DataFrame) -> DataFrame:
        found = frontier.join(links, "_at").select(
            "page_id", "id", "parent_id", "position", "descend", "edge", F.concat("path", "piece").alias("path"))
        return _smallest_path(found, key)

    empty_path = F.array().cast("array<int>").alias("path")
    reached = level = scratch.cut(next_level(roots.select("page_id", F.col("page_id").alias("_at"), empty_path).distinct()))
    while True:
        found = next_level(level.filter("descend").select("page_id", F.col("id").alias("_at"), "path"))
        known = reached.select("page_id", "id", F.col("path").alias("_known"))
        better = scratch.cut(found.join(known, key, "left")
                             .filter(F.col("_known").isNull() | (F.col("path") < F.col("_known"))).drop("_known"))
        if better.isEmpty():
            return reached
        before, reached = reached, scratch.cut(_smallest_path(reached.unionByName(better), key))
        for done in {id(before): before, id(level): level}.values():
            scratch.drop(done)
        level = better


def _smallest_path(found: DataFrame, key: list[str]) -> DataFrame:
    others = [c for c in found.columns if c not in [*key, "path"]]
    best = found.groupBy(*key).agg(F.min(F.struct("path", *others)).alias("_best"))
    return best.select(*key, *[F.col("_best")[c].alias(c) for c in ["path", *others]]).select(*found.columns)


def page_blocks(roots: DataFrame, children: DataFrame, order_by: Sequence[str] = ("seq",),
                landing: str | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Blocks of each page with payload, ready for the block mapping.

    ``landing`` names a column that grows with each landing of a child list;
    without it all rows of a parent are one list. Payloads are met again by
    the number of their row, so nothing hangs on ordering values being unique.
    """
    scratch = scratch or Scratch(children.sparkSession)
    listed = numbered_children(latest_lists(children, landing) if landing else children, order_by, scratch)
    placed = walk(roots, listed.drop("payload"), scratch)
    return (placed.join(listed.select("edge", "payload"), "edge")
            .select("page_id", "depth", "position", "path", "parent_id", "payload"))
