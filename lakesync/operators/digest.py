"""What really changed: rows and groups compared with the stored ones by digest.

A digest is stored with each row, so only keys and digests of a table are read
to find the rows of a delta that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGEST = "row_digest"
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def row_digest(rows: DataFrame, but: Sequence[str] = ()) -> Column:
    """128 bits of a row's content, some columns left out; a missing value and an empty one differ."""
    def column(name: str) -> Column:
        return F.col("`" + name.replace("`", "``") + "`")

    spelled = [F.to_json(column(f.name)).alias(f.name) if isinstance(f.dataType, T.VariantType) else column(f.name)
               for f in sorted(rows.schema, key=lambda f: f.name) if f.name not in but]
    return F.unhex(F.md5(F.to_json(F.struct(*spelled), {"timestampFormat": _MICROS, "timestampNTZFormat": _MICROS})))


def changed_rows(rows: DataFrame, stored: DataFrame, key: Sequence[str], but: Sequence[str] = ()) -> DataFrame:
    """Rows that are not stored like this under their key; ``stored`` has the key and ``DIGEST``. A key with NULL is never stored."""
    known = stored.select(*key, DIGEST)
    return rows.withColumn(DIGEST, row_digest(rows, but)).join(known, [*key, DIGEST], "left_anti").select(*rows.columns)


def changed_groups(rows: DataFrame, stored: DataFrame, groups: DataFrame, group: str, key: Sequence[str], but: Sequence[str] = ()) -> DataFrame:
    """Groups (one column) whose rows are not exactly the stored ones, by count and two sums of row digests.

    Each task adds its rows up before anything is shuffled, so a group of any size costs one row a task.
    """
    listed = groups.select(group).distinct()
    sums = [F.sum(F.xxhash64(F.lit(salt), F.to_json(F.struct(*key)), DIGEST).cast("decimal(20,0)")) for salt in (1, 2)]

    def summed(some: DataFrame, name: str) -> DataFrame:
        of_listed = some.select(*dict.fromkeys([*key, group, DIGEST])).join(listed, group, "left_semi")
        return of_listed.groupBy(group).agg(F.struct(F.count(F.lit(1)), *sums).alias(name))

    both = listed.join(summed(stored, "_old"), group, "left").join(summed(rows.withColumn(DIGEST, row_digest(rows, but)), "_new"), group, "left")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(group)
