"""Numbering rows in order without gathering them in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesync.session import Scratch


def ordered_index(df: DataFrame, order_by: Sequence[str], within: Sequence[str] = (),
                  name: str = "position", number: str | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Add each row's 0-based place in ``order_by`` order, within its group if one is given.

    Rows are range-partitioned on group and order together, so a group holding
    most rows spreads over many partitions. Rows are numbered within their
    partition; one count per (group, partition) says how many come before it.
    ``number`` names one more column, a value no other row has.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = [F.col(c).asc_nulls_first() for c in [*within, *order_by]]
    groups = [F.col(c) for c in within]
    # written, because the range a row falls into may differ when it is computed again
    ranged = (scratch or Scratch(df.sparkSession)).cut(
        df.repartitionByRange(partitions, *place).withColumn("_part", F.spark_partition_id()))
    runs = ranged.groupBy(*within, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (Window.partitionBy(*groups or [F.lit(0)]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select(
        *[F.col(c).alias("_g_" + c) for c in within], F.col("_part").alias("_run_part"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same_run = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("_g_" + c)) for c in within],
                      F.col("_part") == F.col("_run_part"))
    here = F.row_number().over(Window.partitionBy("_part", *groups).orderBy(*[F.col(c).asc_nulls_first() for c in order_by])) - 1
    rows = ranged.withColumn("_here", here).join(starts, same_run)
    extra = [F.monotonically_increasing_id().alias(number)] if number else []
    return rows.select(*df.columns, (F.col("_here") + F.col("_before")).alias(name), *extra)


def keyset_chunks(ids: DataFrame, id_column: str, cap: int) -> DataFrame:
    """Chunks of at most ``cap`` ids in numeric order: each starts after the id the one before ended with."""
    numbers = ids.select(F.col(id_column).cast("bigint").alias("id"))
    chunks = (ordered_index(numbers, ["id"], name="_index")
              .groupBy(F.floor(F.col("_index") / cap).alias("chunk"))
              .agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("n_ids")))
    before = chunks.select((F.col("chunk") + 1).alias("chunk"), F.col("last_id").alias("after_id"))
    return chunks.join(before, "chunk", "left").select("chunk", "after_id", "first_id", "last_id", "n_ids")
