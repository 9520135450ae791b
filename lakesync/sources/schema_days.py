"""The schema of a document landing as state: one per landed day, merged, so that a run parses new days alone."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.sources.landing import DAY

STATE = "day date, found string"
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def variant_type(ddl: str) -> T.DataType:
    """The type a schema of variants spells; its objects are structs."""
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], ddl)
    return T.StructType.fromDDL(f"doc {ddl}")["doc"].dataType


def merged(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type of values of both types; VARIANT where they do not go together, as within one day."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        kinds = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            kinds[f.name] = merged(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
        return T.StructType([T.StructField(name, kinds[name]) for name in sorted(kinds)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged(a.elementType, b.elementType))
    return _number(a, b) or T.VariantType()


def _number(a: T.DataType, b: T.DataType) -> T.DataType | None:
    numbers = (*_WHOLE, T.DecimalType, T.FloatType, T.DoubleType)
    if not (isinstance(a, numbers) and isinstance(b, numbers)):
        return None
    if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        parts = [(k.precision - k.scale, k.scale) if isinstance(k, T.DecimalType) else (_WHOLE[type(k)], 0) for k in (a, b)]
        whole, scale = max(p[0] for p in parts), max(p[1] for p in parts)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    return max(a, b, key=lambda kind: _WHOLE[type(kind)])


def day_schemas(lines: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``day, found`` for the landed days whose schema is not known for good: the newest known day and later ones.

    ``lines`` have ``payload`` and the day they landed. A day's files only grow
    until the next day lands, so earlier days are never listed or read again.
    Types are merged per task and then once a day.
    """
    newest = None if known is None else known.agg(F.max("day")).first()[0]
    new = lines if newest is None else lines.where(F.col(DAY) >= F.lit(newest))
    parsed = new.select(F.col(DAY).alias("day"), F.parse_json("payload").alias("doc"))
    return parsed.groupBy("day").agg(F.schema_of_variant_agg("doc").alias("found"))


def updated(known: DataFrame, found: DataFrame) -> DataFrame:
    """The state after a run: what was found replaces what was known of a day."""
    return known.join(found, "day", "left_anti").unionByName(found)


def whole_schema(found: Iterable[str]) -> T.DataType:
    """The type of the documents of all days; there are as many texts as days."""
    return reduce(merged, map(variant_type, found), T.NullType())
