"""Substring dedup: words inside passages that also stand in a document with a smaller id are removed.

A passage is any run of ``window`` words. Phrases: each window has a chosen phrase of ``phrase`` words (the one with the
least hash), so equal windows choose equal phrases, and about every fourth phrase of a text is chosen. Steps:

1. The chosen phrases of all documents meet by hash; those of two or more different texts recur. Whole texts meet too:
   of equal ones only the smallest id goes on, the others lose all their words.
2. Documents go in blocks. The recurring phrases of a block become its Aho-Corasick automaton, and the block's documents
   are streamed through it, which locates every occurrence. Windows without one cannot recur; the others are candidates.
3. Candidate windows of all documents meet by a 96-bit hash of their words, which confirms them and finds the least id.
4. Back in its block, each document loses the words of windows that a smaller id has.

Blocks are summed up before anything is shuffled: a phrase or window counts once per block, however many copies of it
the block holds, so a passage in a third of all documents costs one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.llm.shared import Scratch, batches, partitions, split_words, utf8

#: Bytes of text after which a block is closed; its automaton has at most about a quarter as many phrases as words.
BLOCK_BYTES = 3_000_000
#: Bytes of packed blocks and keys after which a record batch goes back to Spark.
_BATCH_BYTES = 4 << 20

_B1, _B2, _B3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _B2
    return values ^ (values >> np.uint64(29))


def _rolled(values: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Hash of every run of ``size`` values, as a polynomial in ``base`` modulo 2**64, mixed at the end."""
    count = max(0, len(values) - size + 1)
    total = np.zeros(count, np.uint64)
    for j in range(size if count else 0):
        total = total * base + values[j:count + j]
    return _mixed(total)


class Words:
    """The words of several texts in a row, as hashes, with the places where a window may start.

    Everything is computed for all texts at once; a window never reaches into the next text.
    """

    def __init__(self, texts: pa.Array, window: int):
        self.sizes, self.words = split_words(texts)
        coded = self.words.dictionary_encode()
        known = np.fromiter(map(xxhash.xxh3_64_intdigest, utf8(coded.dictionary)), np.uint64, len(coded.dictionary))
        self.values = known[np.asarray(coded.indices)] if len(known) else np.empty(0, np.uint64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.texts = np.repeat(np.arange(len(self.sizes)), self.sizes)
        ends = np.repeat(self.begins + self.sizes, self.sizes)
        self.window = window
        self.starts = np.flatnonzero(np.arange(len(self.values)) + window <= ends)

    def chosen_phrases(self, phrase: int) -> tuple[np.ndarray, np.ndarray]:
        """Phrase hashes by place, and for every window the place of its least phrase (the first of equal ones)."""
        hashes = _rolled(self.values, phrase, _B3) >> np.uint64(16) << np.uint64(16)  # 48 bits: this step only sifts
        if not len(self.starts):
            return hashes, np.empty(0, np.int64)
        least, place = hashes[self.starts], self.starts.copy()
        for j in range(1, self.window - phrase + 1):  # place by place: all windows at once would be as many copies of the hashes
            other = hashes[self.starts + j]
            less = other < least
            least[less] = other[less]
            place[less] = self.starts[less] + j
        return hashes, place

    def windows(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 further bits for the windows at some places."""
        other = (self.values ^ (self.values >> np.uint64(27))) * _B3
        return _rolled(self.values, self.window, _B1)[starts], (_rolled(other, self.window, _B2)[starts] >> np.uint64(32)).astype(np.uint32)

    def contents(self) -> tuple[np.ndarray, np.ndarray]:
        """64 and 31 further bits for every whole text."""
        place = np.arange(len(self.values)) - self.begins[self.texts]
        out = []
        for base, values in ((_B1, self.values), (_B2, (self.values ^ (self.values >> np.uint64(27))) * _B3)):
            powers = np.cumprod(np.full(int(self.sizes.max(initial=0)) + 1, base, np.uint64))
            total = np.concatenate(([np.uint64(0)], np.cumsum(values * powers[place], dtype=np.uint64)))
            out.append(_mixed(total[self.begins + self.sizes] - total[self.begins] + self.sizes.astype(np.uint64)))
        return out[0], (out[1] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Integers byte by byte of their value and compressed; rising ones as their differences."""
    values = values.view(f"u{values.itemsize}")
    if rising and len(values):
        values = np.concatenate((values[:1], np.diff(values)))
    data = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()
    return len(data).to_bytes(8, "little") + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def _unpack(data: bytes, kind: type, rising: bool = False) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    values = np.ascontiguousarray(planes.T).view(f"u{np.dtype(kind).itemsize}").ravel()
    return (np.cumsum(values, dtype=values.dtype) if rising else values).view(kind)


def _written(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    codec = pa.Codec("zstd", compression_level=6)  # texts are most of what is shuffled
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _read(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Runs of rows with about ``BLOCK_BYTES`` of text, named by a hash of their ids and texts."""

    def closed():
        table = pa.Table.from_batches(held).combine_chunks()
        name = xxhash.xxh3_64(str(table.column("doc_id").to_pylist()))
        name.update(b"\0".join(utf8(_column(table, "text"))))
        return name.intdigest() - (1 << 63), table

    held, weight = [], 0
    for part in parts:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(part.column("text")), 0), np.int64))
        begin = 0
        while begin < part.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + BLOCK_BYTES - weight, side="right")))
            held.append(part.slice(begin, end - begin))
            weight += int(ends[end - 1]) - before
            begin = end
            if weight >= BLOCK_BYTES or begin < part.num_rows:
                yield closed()
                held, weight = [], 0
    if held:
        yield closed()


_ENTRY = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("kind", pa.int8()), ("h1", pa.binary()), ("h2", pa.binary()),
                    ("lo", pa.binary()), ("hi", pa.binary()), ("rows", pa.binary())])
_TYPES = "shard int, block long, kind byte, h1 binary, h2 binary, lo binary, hi binary, rows binary"
#: Kinds of rows: keys of a block, rows still to be judged, rows that are final.
KEYS, ROWS, FINAL = 0, 1, 2


def _entries(block: int, h1: np.ndarray, h2: np.ndarray, ids: np.ndarray, count: int) -> Iterator[tuple]:
    """One entry per key of a block with its least and greatest id, dealt to shards by the key."""
    if not len(h1):
        return
    order = np.lexsort((ids, h2, h1))
    h1, h2, ids = h1[order], h2[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))))
    last = np.concatenate((first[1:], [len(h1)])) - 1
    h1, h2, lo, hi = h1[first], h2[first], ids[first], ids[last]
    shards = ((h1 >> np.uint64(20)) % np.uint64(count)).astype(np.int64)
    order = np.argsort(shards, kind="stable")
    for chosen in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1):
        yield (int(shards[chosen[0]]), block, KEYS, _pack(h1[chosen], True), _pack(h2[chosen]), _pack(lo[chosen]),
               _pack(hi[chosen] - lo[chosen]), None)


def _recurring(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one shard's entries, those whose key has two or more ids, with the least one, back to their blocks."""

    def rows():
        held = []
        for part in parts:
            for block, h1, *packed in zip(*(part.column(name).to_pylist() for name in ("block", "h1", "h2", "lo", "hi"))):
                h2, lo, hi = (_unpack(data, kind) for data, kind in zip(packed, (np.uint32, np.int64, np.int64)))
                held.append((block, _unpack(h1, np.uint64, True), h2, lo, lo + hi))
        if not held:
            return
        h1, h2, lo, hi = (np.concatenate([entry[i] for entry in held]) for i in range(1, 5))
        order = np.lexsort((h2, h1))
        new = np.concatenate(([True], (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])))
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        least, most = np.minimum.reduceat(lo[order], first)[group], np.maximum.reduceat(hi[order], first)[group]
        low, keep = np.empty_like(lo), np.empty(len(lo), bool)
        low[order], keep[order] = least, least < most
        low[h2 == 0] = 0  # of phrases it is enough to know that they recur
        at = 0
        for block, own, *_ in held:
            here = np.s_[at:at + len(own)]
            at += len(own)
            mask = keep[here]
            if mask.any():
                yield (None, block, KEYS, _pack(h1[here][mask], True), _pack(h2[here][mask]), _pack(low[here][mask]), None, None)

    return batches(rows(), _ENTRY)


def _by_block(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple, bytes]]:
    """(block, its keys as sorted (h1, h2, least id), rows), from entries sorted by block and kind."""
    block, keys, table = None, [], None
    for part in parts:
        for at, kind, h1, h2, lo, rows in zip(*(part.column(name).to_pylist() for name in ("block", "kind", "h1", "h2", "lo", "rows"))):
            if at != block:
                block, keys, table = at, [], None
            if kind == KEYS:
                keys.append((_unpack(h1, np.uint64, True), _unpack(h2, np.uint32), _unpack(lo, np.int64)))
                continue
            if table is None:
                table = tuple(np.concatenate([key[i] for key in keys]) if keys else np.empty(0, kind) for i, kind in enumerate((np.uint64, np.uint32, np.int64)))
                order = np.lexsort((table[1], table[0]))
                table, keys = tuple(column[order] for column in table), []
            yield block, table, rows


def _least_id(keys: tuple, h1: np.ndarray, h2: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
    """The least id of each key that recurs; ``otherwise`` of the others."""
    out = otherwise.copy()
    at = np.searchsorted(keys[0], h1)
    while len(keys[0]):  # keys with an equal first part lie side by side
        here = at < len(keys[0])
        here[here] = keys[0][at[here]] == h1[here]
        if not here.any():
            break
        same = here.copy()
        same[here] = keys[1][at[here]] == h2[here]
        out[same] = keys[2][at[same]]
        at = at + here
    return out


def _located(words: Words, recurring: np.ndarray, phrase: int, open_: np.ndarray) -> np.ndarray:
    """Starts of the windows of open texts whose least phrase the automaton of the recurring phrases finds."""
    hashes, least = words.chosen_phrases(phrase)
    places = np.unique(least[open_[words.texts[words.starts]]]) if len(least) else least
    at = np.minimum(np.searchsorted(recurring, hashes[places]), max(0, len(recurring) - 1))
    places = places[recurring[at] == hashes[places]] if len(recurring) else places[:0]
    if not len(places):
        return words.starts[:0]
    spelled = utf8(words.words)
    automaton = ahocorasick.Automaton()
    _, distinct = np.unique(hashes[places], return_index=True)
    for place in places[distinct].tolist():
        automaton.add_word((b" " + b" ".join(spelled[place:place + phrase]) + b" ").decode("utf-8", "replace"), True)
    automaton.make_automaton()
    found = np.zeros(len(words.values) + 1, bool)
    for text in np.unique(words.texts[places]).tolist():
        begin, size = int(words.begins[text]), int(words.sizes[text])
        line = (b" " + b" ".join(spelled[begin:begin + size]) + b" ").decode("utf-8", "replace")
        ends = np.cumsum(np.asarray(pc.utf8_length(words.words.slice(begin, size)), np.int64) + 1)  # the blank after each word
        last = np.searchsorted(ends, np.fromiter((end for end, _ in automaton.iter(line)), np.int64))
        found[begin + last - phrase + 1] = True
    return words.starts[found[least] & open_[words.texts[words.starts]]]


def dedup(docs: DataFrame, window: int = 13, phrase: int = 6, scratch: Scratch | None = None) -> DataFrame:
    """All columns of ``docs`` with ``text`` cleaned, and ``n_words``, ``n_removed``.

    A text that loses words becomes its other words joined by one blank; any other text stays as it is. Windows are
    judged on the input. Equal ids are not smaller than each other; rows with a null id neither lose words nor make
    others lose any. Texts shorter than a window stay whole. Columns of ``docs`` called ``n_words`` or ``n_removed``
    are replaced. ``docs`` must give the same rows when read again, as a table does.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    count = partitions(docs.sparkSession)
    docs = docs.drop("n_words", "n_removed")
    result_schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    names = docs.columns

    def ids_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = _column(table, "doc_id")
        return np.asarray(ids.fill_null(0).cast(pa.int64())), ~np.asarray(ids.is_null().to_numpy(zero_copy_only=False))

    def first_keys(parts):
        for block, table in _blocks(parts):
            words = Words(_column(table, "text"), window)
            ids, named = ids_of(table)
            hashes, least = words.chosen_phrases(phrase)
            places = np.unique(least)
            places = places[named[words.texts[places]]]
            content, more = words.contents()
            whole = named & (words.sizes >= window)
            yield from _entries(
                block, np.concatenate((hashes[places], content[whole])), np.concatenate((np.zeros(len(places), np.uint32), more[whole])),
                np.concatenate((content[words.texts[places]].view(np.int64), ids[whole])), count)

    def rows_of(parts):
        for block, table in _blocks(parts):
            yield None, block, ROWS, None, None, None, None, _written(table)

    def final(block: int, table: pa.Table, removed: np.ndarray):
        if table.num_rows:
            yield None, block, FINAL, None, None, None, None, _written(table.append_column("n_removed", pa.array(removed, pa.int64())))

    def emptied(table: pa.Table) -> pa.Table:
        place = table.schema.get_field_index("text")
        return table.set_column(place, table.schema.field(place), pa.array([""] * table.num_rows, table.schema.field(place).type))

    def candidates(parts):
        for block, keys, data in _by_block(parts):
            table = _read(data)
            words = Words(_column(table, "text"), window)
            ids, named = ids_of(table)
            long = named & (words.sizes >= window)
            copy = long & (_least_id(keys, *words.contents(), ids) < ids)
            starts = _located(words, keys[0][keys[1] == 0], phrase, long & ~copy)
            table = table.append_column("n_words", pa.array(words.sizes))
            waits = np.zeros(table.num_rows, bool)
            waits[words.texts[starts]] = True
            yield from final(block, emptied(table.filter(pa.array(copy))), words.sizes[copy])
            kept = ~copy & ~waits
            yield from final(block, table.filter(pa.array(kept)), np.zeros(int(kept.sum()), np.int64))
            if waits.any():
                yield None, block, ROWS, None, None, None, None, _written(table.filter(pa.array(waits)))
                yield from _entries(block, *words.windows(starts), ids[words.texts[starts]], count)

    def cleaned(parts):
        for _, keys, data in _by_block(parts):
            table = _read(data)
            words = Words(_column(table, "text"), window)
            ids, _ = ids_of(table)
            owner = ids[words.texts[words.starts]]
            known = words.starts[_least_id(keys, *words.windows(words.starts), owner) < owner]
            edge = np.zeros(len(words.values) + 1, np.int64)
            np.add.at(edge, known, 1)
            np.add.at(edge, known + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed = np.bincount(words.texts[gone], minlength=table.num_rows)
            offsets = np.concatenate(([0], np.cumsum(words.sizes - removed)))
            others = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.words.filter(pa.array(~gone)))
            place = table.schema.get_field_index("text")
            text = pc.if_else(pa.array(removed > 0), pc.binary_join(others, " "), _column(table, "text"))
            table = table.set_column(place, table.schema.field(place), text)
            yield from table.append_column("n_removed", pa.array(removed, pa.int64())).to_batches()

    def unpacked(parts):
        for part in parts:
            for data in part.column("rows").to_pylist():
                yield from _read(data).to_batches()

    def to_rows(make):
        return lambda parts: batches(make(parts), _ENTRY, size=64, most_bytes=_BATCH_BYTES)

    def met(entries: DataFrame) -> DataFrame:
        return entries.repartitionById(count, "shard").mapInArrow(_recurring, _TYPES)

    def in_blocks(rows: DataFrame) -> DataFrame:
        return rows.repartition(count, "block").sortWithinPartitions("block", "kind")

    known = met(docs.select(names).mapInArrow(to_rows(first_keys), _TYPES))
    held = docs.select(names).mapInArrow(to_rows(rows_of), _TYPES)
    judged = scratch.cut(in_blocks(known.unionByName(held)).mapInArrow(to_rows(candidates), _TYPES))
    again = met(judged.where(F.col("kind") == KEYS)).unionByName(judged.where(F.col("kind") == ROWS))
    changed = in_blocks(again).mapInArrow(cleaned, result_schema)
    done = judged.where(F.col("kind") == FINAL).select("rows").mapInArrow(unpacked, result_schema)
    return changed.unionByName(done)
