"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked within a bit distance by covering hashing.

Covering hashing gives each of the 64 bits a non-zero vector of ``radius + 1`` bits and makes one table per non-zero
vector ``v``: it looks only at bits whose vector has an odd overlap with ``v``. The vectors of ``radius`` differing bits
span too little to meet all ``v``, so in some table none of them is looked at and the pair falls into one bucket.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lakesync.llm.components import components
from lakesync.llm.shared import Scratch, utf8

BITS = 64


def simhash(text: bytes, shingle: int = 3) -> int:
    """Fingerprint of one UTF-8 text: a bit is set if it is set in over half of the shingles' XXH64 (seed 42).

    Only A-Z are lower-cased. A text with fewer words than a shingle is one shingle; one without words gives zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[size - 1:].tolist())], dtype="<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: Column | str, shingle: int = 3) -> Column:
    """Signed 64-bit fingerprint of a text column; zero for null."""

    @arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([simhash(value, shingle) for value in utf8(texts)], dtype=np.uint64).view(np.int64))

    return fingerprints(F.col(text) if isinstance(text, str) else text)


def masks(radius: int) -> list[int]:
    """Bits each table looks at; every pair within ``radius`` bits agrees on all bits of some table."""
    spots = (1 << (radius + 1)) - 1
    return [sum(1 << bit for bit in range(BITS) if ((1 + bit % spots) & v).bit_count() % 2) for v in range(1, spots + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges between distinct fingerprints ``fp`` (long) that connect exactly those within ``radius`` bits.

    Buckets with a single member go. In the others no pairs are made: each member emits itself with up to half the
    radius of the bits flipped that its table does not look at, and members that meet in such a value are linked to the
    least of them. Two values meet exactly if they are within the radius, so a bucket of any size costs a fixed number
    of rows per member. ``radius`` must be even for this.
    """
    if radius < 0 or radius % 2:
        raise ValueError("radius must be even")
    tables = [(number, mask) for number, mask in enumerate(masks(radius))]
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(number).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key")) for number, mask in tables])).alias("_b"))
    keyed = keyed.select("fp", "_b.table", "_b.key")
    shared = keyed.groupBy("table", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("table", "key")
    members = keyed.join(shared, ["table", "key"], "left_semi")
    met = None
    for number, mask in tables:
        free = [bit for bit in range(BITS) if not mask >> bit & 1]
        flips = [sum(1 << bit for bit in chosen) for k in range(radius // 2 + 1) for chosen in combinations(free, k)]
        choice = F.when(F.col("table") == number, F.array(*[F.lit(_signed(flip)) for flip in flips]))
        met = choice if met is None else F.coalesce(met, choice)
    variants = members.select("fp", F.explode(met).alias("_flip")).select("fp", F.col("fp").bitwiseXOR(F.col("_flip")).alias("point"))
    hubs = variants.groupBy("point").agg(F.min("fp").alias("root"), F.max("fp").alias("hi")).where("root < hi").select("point", "root")
    return variants.join(hubs, "point").where("fp != root").select("fp", "root").distinct()


def near_groups(docs: DataFrame, shingle: int = 3, radius: int = 2, keep: tuple[str, ...] = ("doc_id",),
                scratch: Scratch | None = None) -> DataFrame:
    """The kept columns with ``fingerprint`` (16 hex digits), ``root`` (the group) and ``component_id`` per document.

    ``component_id`` is the smallest ``doc_id`` reachable over links, itself included; null if the group has none.
    Documents with equal fingerprints are one node, so thousands of copies cost one row in the graph. Empty texts all
    have fingerprint zero and are linked like any other. An empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    prints = scratch.cut(docs.select(*keep, fingerprint("text", shingle).alias("fp")))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    nodes = scratch.cut(nodes)
    edges = scratch.cut(links(nodes.select("fp"), radius))
    roots = components(edges, scratch)
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    first = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = scratch.cut(placed.join(first, "root").select("fp", "root", "component_id"))
    return prints.join(groups, "fp").select(
        *keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "root", "component_id")
