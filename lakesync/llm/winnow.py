"""Benchmark decontamination by winnowing: spans that documents share with benchmark items, found through fingerprints.

A window is ``span`` consecutive words of an item, or the whole item if it has fewer. From every window the run of about
half its words with the least hash is kept (its fingerprint), so equal windows keep the same one: whatever shared run of
``span`` words there is, it has a fingerprint that both sides kept. Steps:

1. Items give ``fingerprint, key, item``: ``key`` is a 128-bit hash of a window's words.
2. A bit map of the item fingerprints (2**27 bits at most, whatever the benchmark) goes to the tasks; documents are read
   once, and fingerprints whose bit is set are extended to the windows that keep them. Nothing else is written.
3. Both sides meet by fingerprint and key, which is exact: the map only saves rows.
4. Matched windows become word ranges per document. Windows that stand in the same items share a set of items, and
   documents with the same sets share one list, so a window in a third of all documents costs its list once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lakesync.llm.shared import utf8
from lakesync.session import Scratch

#: Words of a window.
SPAN = 10
#: Bytes of text that are held as numpy arrays at once; a longer document is read in pieces that overlap by a window.
PIECE_BYTES = 1_000_000
_LEAST_BITS, _MOST_BITS = 16, 27

_WORD = np.zeros(256, bool)
_WORD[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
_BETWEEN = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_B2, _B3 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
#: A random number for each byte.
_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)


def scheme(span: int) -> tuple[int, int]:
    """Words of a fingerprint, and how many of them lie in a window of ``span`` words."""
    size = (span + 1) // 2
    return size, span - size + 1


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _B2
    values = (values ^ (values >> np.uint64(29))) * _B3
    return values ^ (values >> np.uint64(32))


@lru_cache(maxsize=1)
def _table(bits: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full((1 << bits) - 1, base)))) for base in (_ODD, _UNDO))


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of word hashes, and of its inverse."""
    return _table(max(21, count.bit_length()))


class Words:
    """The words of some texts in a row: where they begin and end, to which text they belong, and a hash of each."""

    def __init__(self, texts: list[bytes]):
        self.data = b" ".join(texts).translate(_LOWER)
        raw = np.frombuffer(self.data, np.uint8)
        inside = np.concatenate(([False], _WORD[raw], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.begins, self.ends = edges[::2], edges[1::2]
        firsts = np.searchsorted(self.begins, np.cumsum([0, *(len(text) + 1 for text in texts)]))
        self.sizes = np.diff(firsts)
        self.text = np.repeat(np.arange(len(texts)), self.sizes)
        self.first, self.last = firsts[:-1][self.text], firsts[1:][self.text]  # words of the own text
        up, down = _powers(len(raw))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * up[:len(raw)])))
        self.hashes = _mixed((total[self.ends] - total[self.begins]) * down[self.begins] + (self.ends - self.begins).astype(np.uint64))

    def prints(self, span: int) -> np.ndarray:
        """Hash of every run of words of the fingerprint size of ``span``."""
        size, _ = scheme(span)
        count = max(0, len(self.hashes) - size + 1)
        total = np.full(count, span, np.uint64)
        for j in range(size if count else 0):
            total = total * _ODD + self.hashes[j:count + j]
        return _mixed(total)

    def kept(self, prints: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        """The windows (first word) that keep the fingerprints at some places, and these places."""
        size, width = scheme(span)
        starts = (at[:, None] - np.arange(width)[None, :]).ravel()
        places = np.repeat(at, width)
        fits = (starts >= self.first[places]) & (starts + span <= self.last[places])
        starts, places = starts[fits], places[fits]
        best = prints[starts[:, None] + np.arange(width)[None, :]].argmin(axis=1) + starts if len(starts) else starts
        return starts[best == places], places[best == places]

    def key(self, start: int, span: int) -> bytes:
        return xxhash.xxh3_128_digest(b" ".join(self.data[a:b] for a, b in zip(self.begins[start:start + span].tolist(), self.ends[start:start + span].tolist())))


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int, Words, bool]]:
    """``text, word, words, whole``: texts in a row, or a piece of one long text.

    ``text`` is the number of the first text, ``word`` that of the first word in its text, and ``whole`` tells whether
    the texts are there from end to end. A piece of a long text repeats the last ``SPAN - 1`` words of the one before.
    """
    held, size, first = [], 0, 0
    for number, value in enumerate(utf8(texts)):
        if held and size + len(value) > PIECE_BYTES:
            yield first, 0, Words(held), True
            held, size = [], 0
        if len(value) > PIECE_BYTES:
            yield from ((number, word, words, whole) for word, words, whole in _long(value))
            first = number + 1
            continue
        if not held:
            first = number
        held.append(value)
        size += len(value)
    if held:
        yield first, 0, Words(held), True


def _long(value: bytes) -> Iterator[tuple[int, Words, bool]]:
    at = word = 0
    while True:
        take = PIECE_BYTES
        while True:
            cut = _BETWEEN.search(value, at + take)
            end = cut.start() if cut else len(value)
            words = Words([value[at:end]])
            if end == len(value) or len(words.begins) >= 2 * SPAN:
                break
            take *= 2  # very long words
        yield word, words, end - at == len(value)
        if end == len(value):
            return
        word += len(words.begins) - (SPAN - 1)
        at += int(words.begins[1 - SPAN])


def windows(texts: pa.Array, spans: list[int] | None = None, wanted: Callable[[np.ndarray], np.ndarray] | None = None
            ) -> tuple[np.ndarray, list[tuple[int, int, int, bytes, int]]]:
    """Number of words of each text, and ``text, span, fingerprint, key, first word`` of windows.

    With ``spans``, all windows of these sizes whose fingerprint is wanted; without, each text's own ones.
    """
    sizes, found = np.zeros(len(texts), np.int64), []
    for first, word, words, whole in _pieces(texts):
        count = len(words.sizes)
        sizes[first:first + count] = word + words.sizes
        own = np.minimum(words.sizes, SPAN) if whole else np.full(count, SPAN)
        for span in sorted(set(own.tolist()) - {0}) if spans is None else spans:
            prints = words.prints(span)
            seen = word + SPAN - span if word else 0  # windows that begin before were in the last piece
            wants = np.ones(len(prints), bool) if wanted is None else wanted(prints)
            if spans is None:
                wants &= own[words.text[:len(prints)]] == span
            at = np.flatnonzero(wants)
            for some in range(0, len(at), 1 << 16):
                starts, places = words.kept(prints, at[some:some + (1 << 16)], span)
                inside = word + starts - words.first[starts]
                new = inside >= seen
                starts, places, inside = starts[new], places[new], inside[new]
                for start, place, text, print_ in zip(starts.tolist(), inside.tolist(), words.text[starts].tolist(), prints[places].view(np.int64).tolist()):
                    found.append((first + text, span, print_, words.key(start, span), place))
    return sizes, found


_ITEM = pa.schema([("item_id", pa.int64()), ("span", pa.int32()), ("print", pa.int64()), ("key", pa.binary())])
_WINDOWS = pa.list_(pa.struct([("print", pa.int64()), ("key", pa.binary()), ("span", pa.int32()), ("starts", pa.list_(pa.int32()))]))


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def item_windows(items: DataFrame) -> DataFrame:
    """``item_id, span, print, key``: every window of every item, once."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column(0).to_pylist()
            rows = [(ids[text], span, print_, key) for text, span, print_, key, _ in windows(part.column(1))[1]]
            for some in range(0, len(rows), 1 << 16):
                yield _columns(rows[some:some + (1 << 16)], _ITEM)

    read = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(run, "item_id long, span int, print long, key binary").distinct()


def _bit_map(prints: DataFrame) -> np.ndarray:
    """A map with the bit of every fingerprint set: 16 bits for each, between 2**16 and 2**27 in all (16 MB)."""
    count = prints.count()
    bits = min(_MOST_BITS, max(_LEAST_BITS, (16 * count).bit_length()))
    spot = F.col("print").bitwiseAND(F.lit((1 << bits) - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int"))
    words = prints.groupBy(F.shiftright(spot, 6).alias("place")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[np.asarray(words.column("place"), np.int64)] = np.asarray(words.column("bits"), np.int64)
    return out.view(np.uint8)


def _candidates(docs: DataFrame, spans: list[int], bit_map: np.ndarray) -> DataFrame:
    """``doc_id, row, n_words, windows``: for each document the windows whose fingerprint may be an item's."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_map)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        mask = np.uint64(len(bits) * 8 - 1)

        def wanted(prints: np.ndarray) -> np.ndarray:
            place = prints & mask
            return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0

        for part in parts:
            sizes, found = windows(part.column(2), spans, wanted)
            held: dict[int, dict] = {}
            for text, span, print_, key, start in found:
                held.setdefault(text, {}).setdefault((print_, key, span), []).append(start)
            lists = [[{"print": p, "key": k, "span": s, "starts": at} for (p, k, s), at in held[n].items()] if n in held else [] for n in range(len(sizes))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(lists, _WINDOWS)],
                                             names=["doc_id", "row", "n_words", "windows"])
        pa.default_memory_pool().release_unused()

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))
    return ids.mapInArrow(run, "doc_id long, row long, n_words long, windows array<struct<print: long, key: binary, span: int, starts: array<int>>>")


def _ranges(windows: pa.Array) -> pa.Array:
    """The words that windows cover, as ranges that do not touch."""
    out = []
    for document in windows.to_pylist():
        starts = np.concatenate([np.array(window["starts"], np.int64) for window in document])
        stops = starts + np.repeat([window["span"] for window in document], [len(window["starts"]) for window in document])
        order = np.argsort(starts, kind="stable")
        starts, reach = starts[order], np.maximum.accumulate(stops[order])
        fresh = np.concatenate(([True], starts[1:] > reach[:-1]))
        last = np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(starts) - 1]))
        out.append([{"start": a, "stop": b} for a, b in zip(starts[fresh].tolist(), reach[last].tolist())])
    return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))


def _list_digests(lists: DataFrame) -> DataFrame:
    """``list, n_items, items_sha256`` of ``list, item`` rows: items in order, joined by commas, never held together."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count, digest = None, 0, None
        for part in parts:
            done = []
            for name, item in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if name != now:
                    if now is not None:
                        done.append((now, count, digest.hexdigest()))
                    now, count, digest = name, 0, hashlib.sha256()
                digest.update(b"," * (count > 0) + item.encode())
                count += 1
            if done:
                yield _columns(done, _LIST)
        if now is not None:
            yield _columns([(now, count, digest.hexdigest())], _LIST)

    dealt = lists.repartition("list").sortWithinPartitions("list", "item")
    return dealt.mapInArrow(run, "list string, n_items long, items_sha256 string")


_LIST = pa.schema([("list", pa.string()), ("n_items", pa.int64()), ("items_sha256", pa.string())])


def decontaminate(docs: DataFrame, benchmark: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, n_words, ranges, n_items, items_sha256``, one row per row of ``docs``.

    Words are runs of digits, a-z and characters beyond ASCII, after A-Z became lower-case. ``ranges`` are the words
    (from 0, stop excluded) inside any occurrence of a window of any item, null if there is none. ``n_items`` counts the
    item ids with an occurring window, ``items_sha256`` is the digest of these ids, sorted as strings and joined by commas.

    Null and empty texts have no words; an item without words has no window. Items that repeat an id are one item,
    repeated documents are rows of their own, null document ids included. A null ``item_id`` marks words but is not
    counted. Other columns of either table are not read. Either table may be empty.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    ranges = arrow_udf(_ranges, "array<struct<start: int, stop: int>>")
    items = scratch.cut(item_windows(benchmark))
    spans = sorted(row["span"] for row in items.select("span").distinct().collect())
    read = scratch.cut(_candidates(docs, spans, _bit_map(items.select("print"))))

    named = items.where("item_id IS NOT NULL")
    sets = named.groupBy("print", "key").agg(F.bit_xor(F.xxhash64("item_id")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "item_id")).alias("b"))
    sets = sets.select("print", "key", F.concat(F.hex("a"), F.lit("-"), F.hex("b")).alias("set"))
    wanted = scratch.cut(items.select("print", "key").distinct().join(sets, ["print", "key"], "left"))
    one_each = wanted.where("set IS NOT NULL").groupBy("set").agg(F.min(F.struct("print", "key")).alias("w")).select("set", "w.print", "w.key")
    members = one_each.join(named, ["print", "key"]).select("set", F.col("item_id").cast("string").alias("item"))

    hits = read.select("row", F.explode("windows").alias("w")).select("row", "w.*").join(wanted, ["print", "key"])
    found = hits.groupBy("row").agg(F.collect_list(F.struct("span", "starts")).alias("windows"), F.array_sort(F.collect_set("set")).alias("sets"))
    found = scratch.cut(found.select("row", ranges("windows").alias("ranges"), "sets", F.sha2(F.array_join("sets", " "), 256).alias("list")))
    lists = found.groupBy("list").agg(F.first("sets").alias("sets")).select("list", F.explode("sets").alias("set"))
    digests = _list_digests(lists.join(members, "set").select("list", "item").distinct())

    named_docs = found.join(digests, "list", "left").select("row", "ranges", "n_items", "items_sha256")
    some = read.where(F.size("windows") > 0).select("doc_id", "row", "n_words").join(named_docs, "row", "left").drop("row")
    none = read.where(F.size("windows") == 0).select("doc_id", "n_words").withColumn("ranges", F.lit(None).cast("array<struct<start: int, stop: int>>"))
    both = some.unionByName(none, allowMissingColumns=True)
    return both.select("doc_id", "n_words", "ranges", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                       F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"))


def digest(found: DataFrame) -> DataFrame:
    """Per document the number of hit words, and whether there is one."""
    n_hit = F.coalesce(F.aggregate("ranges", F.lit(0).cast("long"), lambda total, r: total + (r["stop"] - r["start"])), F.lit(0).cast("long"))
    rows = found.select("doc_id", "n_words", n_hit.alias("n_hit"), "n_items", "items_sha256")
    return rows.withColumn("contaminated", F.col("n_hit") > 0)
