"""Landed documents: schema of all of them, widened types, typed reads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.functions.payload import once
from lakesync.operators.windows import closed
from lakesync.sources.schema_days import variant_type

ID = "_id"


# How exported documents spell types JSON does not have.
_EXPORTED = {"$oid": T.StringType(), "$date": T.TimestampType(), "$numberDecimal": T.DecimalType(38, 10), "$numberLong": T.LongType(),
             "$numberInt": T.IntegerType(), "$numberDouble": T.DoubleType()}
EXTRA = "_extra"
_MILLIS = "@"


def plain_json(payload: Column) -> Column:
    """A document with exported types as bare values: ids and dates as text, numbers as numbers.

    Dates in milliseconds are marked, to tell them from seconds.

    Quotes inside JSON text are escaped, so a text that looks like such a type
    is left alone.
    """
    value = F.regexp_replace(payload, r'\{\s*"\$number(?:Decimal|Long|Int|Double)"\s*:\s*"([-+0-9.eE]+)"\s*\}', "$1")
    value = F.regexp_replace(value, r'\{\s*"\$(?:oid|date)"\s*:\s*("(?:[^"\\]|\\.)*")\s*\}', "$1")
    value = F.regexp_replace(value, r'\{\s*"\$date"\s*:\s*(-?\d+)\s*\}', f'"{_MILLIS}$1"')
    return F.when(payload.contains('"$'), value).otherwise(payload)


def document_schema(lines: DataFrame, sample_size: int | None = None) -> T.StructType:
    """Schema of all documents; a field of mixed types is read as text, one of an exported type as that type.

    Types are merged per task and then once. With ``sample_size`` about so many
    documents, drawn from all of them, are looked at; ``read_documents`` then
    keeps what the sample did not show in ``_extra``.
    """
    if sample_size is not None:
        share = min(1.0, sample_size / max(1, lines.count()))
        lines = lines.sample(fraction=share, seed=0) if share < 1 else lines
    found = lines.select(F.parse_json("payload").alias("doc")).agg(F.schema_of_variant_agg("doc")).first()[0]
    return documents_type(variant_type(found))


def documents_type(inferred: T.DataType) -> T.StructType:
    """Schema to read with from the type that documents were found to have."""
    if not isinstance(inferred, T.StructType):
        raise ValueError("no document to take a schema from")
    return _known(inferred)


def _known(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        if len(kind) == 1 and kind.names[0] in _EXPORTED:
            return _EXPORTED[kind.names[0]]
        return T.StructType([T.StructField(f.name, _known(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_known(kind.elementType))
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def with_room(kind: T.DataType) -> T.DataType:
    """Types for documents nobody has looked at: any number fits where the sample had one of some kind."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, with_room(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(with_room(kind.elementType))
    return T.DecimalType(38, 10) if isinstance(kind, (T.IntegerType, T.LongType, T.DecimalType)) else kind


def widen(kind: T.DataType) -> T.DataType:
    """A type that also holds values of later runs: wide decimals, longs, all nullable."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, widen(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(widen(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, widen(kind.valueType), True)
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, max(kind.scale, 10))
    return T.LongType() if isinstance(kind, T.IntegerType) else kind


def kept_fields(fields: Sequence[str], string_fields: Sequence[str] = (), watermark_field: str | None = None) -> list[str]:
    """Fields to load, always with the key, the text fields and the watermark; empty means all."""
    if not fields:
        return []
    return list(dict.fromkeys([ID, *fields, *string_fields, *([watermark_field] if watermark_field else [])]))


def read_schema(inferred: T.StructType, string_fields: Sequence[str] = (), fields: Sequence[str] = ()) -> T.StructType:
    """Schema to read with: widened, pruned to ``fields`` when given, mixed-type fields as text."""
    unknown = sorted((set(string_fields) | set(fields)) - set(inferred.names))
    if unknown:
        raise ValueError("fields no document has: " + ", ".join(unknown))
    wide = widen(inferred)
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name in string_fields else f.dataType, True, f.metadata)
        for f in wide.fields if not fields or f.name in fields
    ])


def read_documents(lines: DataFrame, schema: T.StructType, watermark_field: str | None = None,
                   since: datetime | None = None, until: datetime | None = None,
                   overlap_seconds: int = 300) -> DataFrame:
    """Documents typed exactly as ``schema`` says, narrowed to the watermark window when there is one.

    A value that does not fit its type fails the job; name the field as a text field.
    A schema with ``_extra`` also keeps, as JSON text, the fields it does not name.
    """
    if watermark_field is None and (since is not None or until is not None):
        raise ValueError("since and until need a watermark field")
    if watermark_field is not None and "modified" in lines.columns:  # a typed landing: before anything is parsed
        lines = closed(lines, "modified", since, until, overlap_seconds)
    named = T.StructType([f for f in schema.fields if f.name != EXTRA])
    typed = once(lines.select("payload"), _plain=plain_json(F.col("payload")))
    typed = once(typed, _doc=F.from_json("_plain", _spelled(named), {"mode": "FAILFAST"}))
    columns = [_instants(F.col("_doc")[f.name], f.dataType).alias(f.name) for f in named.fields]
    if EXTRA in schema.names:
        others = F.map_filter(F.from_json("_plain", "map<string,string>"), lambda name, _: ~name.isin(named.names))
        columns.append(F.when(F.size(others) > 0, F.to_json(others)).alias(EXTRA))
    docs = typed.select(*columns)
    return closed(docs, watermark_field, since, until, overlap_seconds) if watermark_field else docs


def _spelled(kind: T.DataType) -> T.DataType:
    """The type to parse with: times as they are spelled."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _spelled(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_spelled(kind.elementType))
    return T.StringType() if isinstance(kind, T.TimestampType) else kind


def _instants(value: Column, kind: T.DataType) -> Column:
    """The parsed value with its times read: as text, in marked milliseconds, or as a number of seconds."""
    if _spelled(kind) == kind:
        return value
    if isinstance(kind, T.StructType):
        fields = [_instants(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _instants(item, kind.elementType))
    millis, seconds = value.startswith(_MILLIS), value.rlike(r"^-?\d+$")
    return (F.when(millis, F.timestamp_millis(F.substr(value, F.lit(2)).cast("long")))
            .when(seconds, F.timestamp_seconds(value.cast("long"))).otherwise(value.cast("timestamp")))


def read_document_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Documents straight from landed JSON-line files; only the fields in ``schema`` are parsed."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def probe(lines: DataFrame) -> DataFrame:
    """Cheapest real read: one document."""
    return lines.limit(1)
