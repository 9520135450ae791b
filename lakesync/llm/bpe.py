"""BPE encoding by a table of distinct words, and decoding through the table of pieces.

A block is a run of documents one task reads. Its texts become numbers into its own list of distinct words. The lists
are dealt by word, so that every distinct word of all documents meets in one place and is encoded there once; the ids go
back to the blocks, which put them in place of the numbers. What is shuffled is the distinct words of blocks and one
compressed number per word, never words by position, and a word that is everywhere costs one row entry per block.

Blanks separate words and never become part of a piece, so the ids of a text are those of its words in a row.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakesync.llm.shared import batches, partitions, split_words, text_of, utf8

#: Bytes of text after which a block is closed.
BLOCK_BYTES = 6_000_000
#: Words and word parts whose ids a task of the word table keeps.
KEPT_WORDS = 300_000

#: The tokenizer's own rule for splitting lower-cased text (fixed value).
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same rule for words of printable ASCII and Latin-1 letters, on which case and normal form are simple.
_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+\Z")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def read_spec(path: str) -> str:
    """The tokenizer file's text; sent to tasks, which need no file of their own."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves and the others as the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(other)}}


class WordEncoder:
    """Encodes words without blanks; the parts a word falls into are looked up, and new ones merged many at a time."""

    def __init__(self, spec: str):
        content = json.loads(spec)
        self.spec = spec
        model, split = content["model"], (content.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        steps = [step["type"] for step in (content.get("normalizer") or {}).get("normalizers", [])]
        self.simple = (steps == ["NFC", "Replace", "Lowercase"] and split.get("pattern") == {"Regex": _RULE}
                       and model.get("end_of_word_suffix") == "</w>")
        special = [re.escape(token["content"]) for token in content["added_tokens"]]
        self.special = re.compile("|".join(special) if special else r"(?!)")
        self.letters = _byte_letters()
        bare = {**content, "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None,
                "truncation": None, "padding": None, "added_tokens": []}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        vocabulary = model["vocab"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for piece, number in vocabulary.items() if piece.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}

    @cached_property
    def whole(self) -> Tokenizer:
        """The tokenizer as it is, for words the simple rule does not cover."""
        tokenizer = Tokenizer.from_str(self.spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        split, new = [], set()
        for word in words:
            text = word.decode("utf-8", "replace")
            if self.simple and _SIMPLE.match(text) and not self.special.search(text):
                parts = _PARTS.findall(text.lower())
                split.append(parts)
                new.update(parts)
            else:
                split.append(text)
        self._merge(sorted(part for part in new if part not in self.parts))
        known = self.parts
        out = [b"".join([known[part] for part in parts]) if isinstance(parts, list)
               else np.array(self.whole.encode(parts, add_special_tokens=False).ids, "<u4").tobytes() for parts in split]
        if len(known) > KEPT_WORDS:
            self.parts = {}
        return out

    def _merge(self, parts: list[str]) -> None:
        written = [part.encode().decode("latin-1").translate(self.letters) for part in parts]
        lines = [" ".join(written[at:at + 500]) for at in range(0, len(written), 500)]
        for at, found in zip(range(0, len(parts), 500), self.bare.encode_batch_fast(lines, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            pieces = np.split(ids, np.flatnonzero(self.ends[ids])[:-1] + 1)
            chosen = parts[at:at + 500]
            if len(pieces) != len(chosen):
                raise RuntimeError("the tokenizer joined or split words")
            self.parts.update(zip(chosen, (piece.tobytes() for piece in pieces)))


@lru_cache(maxsize=2)
def _encoder(spec: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordEncoder(spec)


def _ints(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, byte by byte of their value and compressed: small ones take little room."""
    data = np.ascontiguousarray(values.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(data).to_bytes(8, "little") + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def _from_ints(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.empty(0, "<u4")
    planes = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(parts: Iterator[pa.RecordBatch], shards: int) -> Iterator[tuple]:
    """(block, words by shard, place of each number among those words, ids of documents, their sizes, their numbers).

    Numbers go by how often a word occurs, which makes most of them small. A block is named by a hash of its words.
    """

    def closed():
        sizes, words = split_words(pa.concat_arrays([part.column(1) for part in held]))
        coded = words.dictionary_encode()
        words, flat = utf8(coded.dictionary), np.asarray(coded.indices)
        often = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        number = np.empty(len(words), "<u4")
        number[often] = np.arange(len(words), dtype="<u4")
        shard = np.fromiter(map(crc32, words), np.uint32, len(words)) % np.uint32(shards)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(words), "<u4")
        place[number[order]] = np.arange(len(words), dtype="<u4")
        by_shard, at = [], 0
        for chosen in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if words else ():
            by_shard.append((int(shard[chosen[0]]), at, [words[i] for i in chosen.tolist()]))
            at += len(chosen)
        block = xxhash.xxh3_64_intdigest(b"\n".join(words)) - (1 << 63)
        return block, by_shard, place, [i for part in held for i in part.column(0).to_pylist()], sizes.astype("<u4"), number[flat]

    held, weight = [], 0
    for part in parts:
        ends = np.cumsum(np.asarray(pc.binary_length(part.column(1)), np.int64))
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


def encode(docs: DataFrame, spec: str) -> DataFrame:
    """``doc_id, ids`` for every document: ids as little-endian unsigned 32-bit integers, no special tokens added.

    Texts without words have no ids. ``docs`` must give the same rows in the same order when read again, as a table
    does: it is read once for words and once for documents. If it does not, the join of ids fails rather than
    mixing them up.
    """
    count = partitions(docs.sparkSession)
    texts = docs.select("doc_id", text_of().alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # the tokenizer file, whose size is fixed
    word_schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("words", pa.binary())])
    row_schema = pa.schema([("block", pa.int64()), ("kind", pa.int8()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                            ("sizes", pa.binary()), ("values", pa.binary()), ("places", pa.binary())])
    row_types = "block long, kind byte, start long, doc_ids array<long>, sizes binary, values binary, places binary"

    def word_rows(parts):
        for block, by_shard, *_ in _blocks(parts, count):
            for shard, start, words in by_shard:
                data = b"\n".join(words)
                yield shard, block, start, len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)

    def doc_rows(parts):
        for block, _, place, ids, sizes, numbers in _blocks(parts, count):
            yield block, 1, None, ids, _ints(sizes), _ints(numbers), _ints(place)

    def encoded(parts):
        encoder, known = _encoder(shared.value), {}
        for part in parts:
            for block, start, data in zip(*(part.column(i).to_pylist() for i in (1, 2, 3))):
                words = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True).split(b"\n")
                new = [word for word in words if word not in known]
                known.update(zip(new, encoder.encode(new)))
                found = [known[word] for word in words]
                sizes = np.fromiter(map(len, found), "<u4", len(found)) // 4
                yield block, 0, start, None, _ints(sizes), _ints(np.frombuffer(b"".join(found), "<u4")), None
                if len(known) > KEPT_WORDS:
                    known = {}

    def to_rows(make, schema):
        return lambda parts: batches(make(parts), schema, size=64)

    words = texts.mapInArrow(to_rows(word_rows, word_schema), "shard int, block long, start long, words binary")
    table = words.repartitionById(count, "shard").mapInArrow(to_rows(encoded, row_schema), row_types)
    numbered = texts.mapInArrow(to_rows(doc_rows, row_schema), row_types)
    rows = table.unionByName(numbered).repartition(count, "block").sortWithinPartitions("block", "kind")
    return rows.mapInArrow(_in_place, "doc_id long, ids binary")


def _in_place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each document from its block's words, whose rows come before the documents."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def rows():
        block, pending = None, []
        for part in parts:
            for at, kind, start, doc_ids, sizes, values, places in zip(*(column.to_pylist() for column in part.columns)):
                if at != block:
                    block, pending = at, []
                if kind == 0:
                    pending.append((start, _from_ints(sizes), _from_ints(values)))
                    continue
                place, end = _from_ints(places), 0
                starts, counts, ids = _block_table(pending, len(place))
                starts, counts = starts[place], counts[place]
                numbers = _from_ints(values)
                for doc_id, size in zip(doc_ids, _from_ints(sizes).tolist()):
                    yield doc_id, _gather(starts, counts, ids, numbers[end:end + size]).tobytes()
                    end += size

    return batches(rows(), schema)


def _block_table(pending: list[tuple], count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and size of the ids of every word of a block, and the ids; from parts in any order, repeated or not."""
    starts, sizes, at = np.full(count, -1, np.int64), np.zeros(count, np.int64), 0
    for start, counts, found in pending:
        if start + len(counts) <= count:
            starts[start:start + len(counts)] = at + np.cumsum(counts, dtype=np.int64) - counts
            sizes[start:start + len(counts)] = counts
        at += len(found)
    if (starts < 0).any():
        raise RuntimeError("the documents were not read alike twice; encode a written table")
    return starts, sizes, np.concatenate([found for *_, found in pending]) if pending else np.empty(0, "<u4")


def _gather(starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    size = sizes[numbers]
    before = np.cumsum(size) - size
    return ids[np.repeat(starts[numbers] - before, size) + np.arange(int(size.sum()))]


@lru_cache(maxsize=2)
def _pieces(spec: str) -> list[str]:
    """The piece of every id; the table has as many rows as the vocabulary, whatever the input."""
    tokenizer = Tokenizer.from_str(spec)
    if tokenizer.decoder is not None:
        raise ValueError("only tokenizers that decode to pieces between blanks are read here")
    return [tokenizer.id_to_token(number) or "" for number in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def decode(encoded: DataFrame, spec: str) -> DataFrame:
    """``doc_id, ids, text``: each id joined to its piece by position, pieces between single blanks.

    Null or empty ids give an empty text. The piece table is sent to every task; its size is the vocabulary's.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(spec)

    def decoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])
        piece = _pieces(shared.value).__getitem__

        def rows():
            for part in parts:
                for doc_id, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    yield doc_id, ids, " ".join(map(piece, np.frombuffer(ids or b"", "<u4").tolist()))

        return batches(rows(), schema)

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids binary, text string")
