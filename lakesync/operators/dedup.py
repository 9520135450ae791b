"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, key: Sequence[str], order_by: str | Sequence[str],
           tie: Sequence[str] = ()) -> DataFrame:
    """One row per key: latest ``order_by``, a missing time sorting lowest; ``tie`` columns
    (an arrival number, say) decide between equal times, the greatest winning.

    Spark keeps only each task's best row per key before the shuffle, so a key
    holding most of the rows costs no more than any other.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    ranking = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in [*order_by, *tie]])
    return df.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")


def newest_counted(df: DataFrame, key: Sequence[str], order_by: str, tie: Sequence[str] = (),
                   copies: str = "_copies") -> DataFrame:
    """As ``newest``, each row also saying how many rows its key had.

    The counts travel with the rows, so their sum stays right when a lost
    executor makes earlier tasks run again.
    """
    age = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate([order_by, *tie])])
    groups = df.groupBy(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(key)])
    best = groups.agg(F.max_by(F.struct(*df.columns), age).alias("_row"), F.count(F.lit(1)).alias(copies))
    return best.select("_row.*", copies)
