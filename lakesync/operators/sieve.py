"""Rows that surely have no partner leave before a join moves them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the map: sixteen for each key, within these bounds (at most 16 MB of bits, as 2**20 words of 64 and more).
LEAST_BITS, MOST_BITS = 16, 27


def _one(spot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int"))


def sieved(rows: DataFrame, keys: DataFrame, key: Sequence[str], count: int) -> DataFrame:
    """Rows with ``_maybe``: false only if their key is surely not among the ``count`` keys.

    Every key sets one bit of a map whose size follows the count up to a bound;
    the map is broadcast as words of 64 bits. With sixteen bits for each key
    one row in seventeen is marked in vain; beyond the bound it is more, and
    still no row is marked wrongly.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * max(1, count) - 1).bit_length()))
    spot = F.pmod(F.xxhash64(*key), F.lit(1 << bits))
    words = keys.select(spot.alias("_spot")).groupBy(F.shiftright("_spot", 6).alias("_word")).agg(F.bit_or(_one(F.col("_spot"))).alias("_bits"))
    placed = rows.withColumn("_spot", spot).withColumn("_word", F.shiftright("_spot", 6))
    found = placed.join(F.broadcast(words), "_word", "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(_one(F.col("_spot"))) != 0, F.lit(False))
    return found.select(*rows.columns, maybe.alias("_maybe"))
