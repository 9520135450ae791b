"""Helpers the operators share: text columns for Arrow functions, word rules."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.functions.payload import once  # noqa: F401
from lakesync.session import Scratch  # noqa: F401

#: Characters between words, as a Java and RE2 class; the same set ``bytes.split()`` splits at.
BLANKS = r"[\x20\x09-\x0D]+"


def text_of(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the maximal runs of characters that are not blanks."""
    return F.array_remove(F.split(text, BLANKS, -1), "")


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 of each value of a text or binary column; empty bytes for nulls."""
    if not len(column):
        return []
    if column.null_count:
        return [value or b"" for value in column.cast(pa.binary()).to_pylist()]
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1].tolist()
    data = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes() if ends[-1] > ends[0] else b""
    first = ends[0]
    return [data[a - first:b - first] for a, b in zip(ends, ends[1:])]


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.StringArray]:
    """Number of words of each text, and the words of all texts in a row (null texts have none)."""
    split = pc.ascii_split_whitespace(texts.fill_null(""))
    real = np.asarray(pc.binary_length(split.values)) > 0  # blanks at the ends of a text give empty words
    sizes = np.diff(np.concatenate(([0], np.cumsum(real)))[np.asarray(split.offsets)])
    return sizes.astype(np.int64), split.values.filter(pa.array(real))


def partitions(spark: SparkSession) -> int:
    """Number of tasks data is dealt to: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bits of the maps that tell early which rows cannot find a partner; their size is the same for any input.
_MAP_BITS = 24


def packed(docs: DataFrame, *out: str) -> DataFrame:
    """Columns named by ``out`` and ``_doc``, a struct of all others, where their names meet no other name."""
    others = [name for name in docs.columns if name not in out]
    return docs.select(*out, F.struct(*[named(name) for name in others]).alias("_doc"))


def named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def unpacked(columns: list[str], **values: Column) -> list[Column]:
    """The columns of a packed frame, some with new values."""
    return [(values[name] if name in values else F.col("_doc").getField(name)).alias(name) for name in columns]


def marked(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows with ``_maybe``: false only if the value is surely not among the keys (one column of longs).

    Each key sets one of 2**24 bits. The bits are sent to every task as at most 2**18 words of 64, whatever the input;
    what is marked gets joined exactly afterwards.
    """
    spot = lambda name: F.pmod(F.xxhash64(F.col(name)), F.lit(1 << _MAP_BITS))
    one = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    bits = keys.select(spot(keys.columns[0]).alias("_spot"))
    bits = bits.groupBy(F.shiftright("_spot", 6).alias("_word")).agg(F.bit_or(one(F.col("_spot"))).alias("_bits"))
    placed = rows.withColumn("_spot", spot(column)).withColumn("_word", F.shiftright("_spot", 6))
    found = placed.join(F.broadcast(bits), "_word", "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(one(F.col("_spot"))) != 0, F.lit(False))
    return found.select(*rows.columns, maybe.alias("_maybe"))


def maybe_in(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The marked rows: all whose value is among the keys, and few others while the keys are few."""
    return marked(rows, column, keys).where("_maybe").drop("_maybe")


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2048, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of tuples, closed by number of rows or by the bytes of their binary and text values."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(value) for value in row if isinstance(value, (bytes, str)))
        if len(held) >= size or weight >= most_bytes:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)
    pa.default_memory_pool().release_unused()  # the worker process lives on


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)
