"""Applying a delta: each function maps (old table, delta) to the new table.

Keys are compared with plain equality, so a key holding NULL never matches.
The key side is reduced to distinct keys before any shuffle and the old table
is only ever filtered, so a small delta is broadcast by Spark and the old
table is not moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesync.operators.dedup import newest
from lakesync.operators.sieve import sieved

# Bytes a key takes in a broadcast table, about.
_KEY_BYTES = 100


def without_keys(target: DataFrame, keys: DataFrame, key: Sequence[str], count: int | None = None) -> DataFrame:
    """Rows of ``target`` whose key is not listed.

    ``count`` is the number of keys, where it is known. Keys too many to be
    broadcast would have the whole target shuffled; then only rows whose key is
    in a bit map of the keys are joined, and the others pass by. The target is
    read twice for it.
    """
    listed = keys.select(*key).distinct()
    if count is None or count * _KEY_BYTES <= _broadcast_bytes(target):
        return target.join(listed, list(key), "left_anti").select(*target.columns)
    marked = sieved(target, listed, key, count)
    joined = marked.where("_maybe").join(listed, list(key), "left_anti")
    return marked.where("NOT _maybe").select(*target.columns).unionByName(joined.select(*target.columns))


def _broadcast_bytes(df: DataFrame) -> int:
    """The session's bound for tables that are broadcast; without one (-1) nothing is."""
    size = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(size)


def overwrite(staged: DataFrame, key: Sequence[str], order_by: str, tie: Sequence[str] = ()) -> DataFrame:
    """The whole new table: the newest staged row per key."""
    return newest(staged, key, order_by, tie)


def upsert(target: DataFrame, staged: DataFrame, key: Sequence[str], order_by: str,
           tie: Sequence[str] = (), unique: bool = False, count: int | None = None) -> DataFrame:
    """Staged rows replace their key's row or are added, whatever their age; ``unique`` ones hold each key once.

    ``count`` is the number of staged rows, where it is known. Without it they
    may be as many as those of the table: then both sides meet once, and
    neither is read twice or broadcast.
    """
    if count is None and not unique:
        return _met(target, staged, key, order_by, tie)
    fresh = (staged if unique else newest(staged, key, order_by, tie)).select(*target.columns)
    return without_keys(target, staged, key, count).unionByName(fresh)


def _met(target: DataFrame, staged: DataFrame, key: Sequence[str], order_by: str, tie: Sequence[str]) -> DataFrame:
    """The newest staged row of each key that has one, and all target rows of the others, by one shuffle.

    Target rows of a key are of equal rank, staged ones go before them in an
    order of their own, so each task keeps one staged row per key before the
    shuffle. A target row with NULL in its key meets nobody.
    """
    columns = target.columns
    order = {f"_staged_{i}": F.col(c) for i, c in enumerate([order_by, *tie])}
    old = target.select(*columns, *[F.lit(None).cast(staged.schema[c].dataType).alias(name) for name, c in zip(order, [order_by, *tie])],
                        F.lit(None).cast("long").alias("_staged_row"),
                        F.when(reduce(Column.__or__, [F.col(c).isNull() for c in key]), F.monotonically_increasing_id()).alias("_apart"))
    new = staged.select(*columns, *[c.alias(name) for name, c in order.items()],
                        F.monotonically_increasing_id().alias("_staged_row"), F.lit(None).cast("long").alias("_apart"))
    ranking = Window.partitionBy(*key, "_apart").orderBy(
        F.col("_staged_row").isNull(), *[F.col(name).desc_nulls_last() for name in order], "_staged_row")
    return old.unionByName(new).withColumn("_rank", F.rank().over(ranking)).filter("_rank = 1").select(*columns)


def flag_archived(target: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows whose id is marked become archived, with the latest mark's time; nothing is added."""
    latest = marks.groupBy("id").agg(F.max("archived_at").alias("_marked_at")).withColumn("_marked", F.lit(True))
    marked = F.col("_marked").isNotNull()
    flagged = {
        "archived": F.when(marked, True).otherwise(F.col("archived")).alias("archived"),
        "archived_at": F.when(marked, F.col("_marked_at")).otherwise(F.col("archived_at")).alias("archived_at"),
    }
    return target.join(latest, "id", "left").select(*[flagged.get(c, F.col(c)) for c in target.columns])


def needed_marks(target: DataFrame, marks: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """The latest mark per id that changes something: the row is there and not yet so flagged, or is about to be replaced."""
    latest = marks.groupBy("id").agg(F.max("archived_at").alias("archived_at"))
    rows = target.select("id", F.col("archived").alias("_flag"), F.col("archived_at").alias("_at"))
    open_ = ~F.coalesce(F.col("_flag"), F.lit(False)) | ~F.col("_at").eqNullSafe(F.col("archived_at"))
    changing = latest.join(rows, "id").where(open_).select("id", "archived_at")
    if staged is not None:
        changing = changing.unionByName(latest.join(staged.select("id").distinct(), "id", "left_semi")).distinct()
    return changing


def replace_by_parent(target: DataFrame, staged: DataFrame, parents: DataFrame, parent: str,
                      key: Sequence[str], order_by: str, tie: Sequence[str] = ()) -> DataFrame:
    """All rows of the listed parents give way to the staged ones; a parent without any is cleared."""
    fresh = newest(staged, key, order_by, tie).select(*target.columns)
    return without_keys(target, parents, [parent]).unionByName(fresh)
