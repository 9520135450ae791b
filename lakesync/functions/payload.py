"""Reading landed JSON records.

A record is parsed once into a VARIANT; every typed column is then a path
lookup in it. Lookups take the path without the leading ``$.``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD = "_record"

# JSON spellings that are false as a truth value.
_FALSY = ("null", "false", "0", '""', "[]", "{}")


def once(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns that are computed a single time per row.

    A filter on a plain column is pushed below the column's definition, which
    repeats it per comparison; that must not happen to parsing. Rows of a
    generator are not looked behind.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select("*", F.inline_outer(F.array(row)))


def with_record(records: DataFrame) -> DataFrame:
    """Add the parsed ``payload`` as ``_record``, unless it is there already."""
    return records if RECORD in records.columns else once(records, **{RECORD: parsed(F.col("payload"))})


def each(df: DataFrame, items: Column, keep: Sequence[str | Column] = (), item: str = "item",
         place: str | None = None) -> DataFrame:
    """One row per element of an array computed from the payload, with its ``place`` if asked for.

    The outer form, because the plain one first filters on the array's size and
    so computes the array again.
    """
    exploded = df.select(*keep, F.posexplode_outer(items).alias(place or "_place", item))
    exploded = exploded.filter(F.col(place or "_place").isNotNull())
    return exploded if place else exploded.drop("_place")


def parsed(payload: Column) -> Column:
    return F.parse_json(payload)


def text_at(record: Column, path: str) -> Column:
    """The value as text: strings as they are, other scalars in JSON spelling, else NULL."""
    return F.try_variant_get(record, "$." + path, "string")


def node_at(record: Column, path: str) -> Column:
    """The value itself; SQL NULL only when the key is absent."""
    return F.variant_get(record, "$." + path, "variant")


def json_at(record: Column, path: str) -> Column:
    return F.to_json(node_at(record, path))


def is_true(record: Column, path: str) -> Column:
    """True only for the JSON boolean ``true``; the text "true" is not."""
    return F.coalesce(json_at(record, path) == "true", F.lit(False))


def truthy(node: Column) -> Column:
    """Whether a JSON value counts as true: not null, false, zero or empty."""
    return F.coalesce(~F.to_json(node).isin(*_FALSY), F.lit(False))


def string_only(record: Column, path: Column) -> Column:
    """The text at a per-row path, NULL when the value there is not a string."""
    node = F.variant_get(record, path, "variant")
    return F.when(F.schema_of_variant(node) == "STRING", node.cast("string"))


def canonical(record: Column) -> Column:
    """The whole record as compact JSON with sorted keys."""
    return F.to_json(record)


def other_fields(record: Column, path: str, known: list[str]) -> Column:
    """JSON of the object's fields outside ``known``, keys sorted; NULL when none are left."""
    fields = F.try_variant_get(record, "$." + path, "map<string,variant>")
    rest = F.map_filter(fields, lambda k, _: ~k.isin(*known))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def plain_text(parts: Column) -> Column:
    """Concatenated ``plain_text`` of rich-text parts; '' for a missing list."""
    texts = F.transform(parts, lambda p: F.coalesce(p["plain_text"], F.lit("")))
    return F.coalesce(F.array_join(texts, ""), F.lit(""))


def first_title(payload: Column) -> Column:
    """Title text of the first property of type ``title``, in document order."""
    # a map keeps the order of the JSON object, a VARIANT does not
    properties = F.from_json(
        payload, "properties map<string,struct<type:string,title:array<struct<plain_text:string>>>>"
    )["properties"]
    title = F.get(F.filter(F.map_values(properties), lambda p: p["type"] == "title"), F.lit(0))
    return F.when(title.isNotNull(), plain_text(title["title"]))
