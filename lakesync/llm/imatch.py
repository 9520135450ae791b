"""I-Match fingerprints: terms of middle inverse document frequency, hashed over many randomised subsets of the lexicon.

A classic I-Match hash changes with one changed term. Here each hash sees only a random part of the lexicon, in parts of
several sizes, so that some hashes of an edited text stay the same and the share of equal hashes tells how alike two
texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.shared import Scratch, batches, marked, maybe_in, partitions, text_of, utf8

EMPTY = "-" * 8
#: A text with fewer terms of the band, or with most of its terms outside, is known by others too: from above and from
#: below the band as many as are missing, at most ``MOST``.
FEWEST, MOST = 32, 128
#: Fingerprints a task keeps, so that copies are seldom made twice.
KEPT_PRINTS = 1 << 13
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Band:
    """Terms in more than ``low`` and at most ``high`` of all documents belong to the lexicon.

    Since no text has more distinct terms than words, at most (mean distinct terms) / ``low`` terms can pass ``low``:
    the lexicon's size does not grow with the number of documents. ``parts`` are the shares of the lexicon the subsets
    take, ``subsets`` of them for each.
    """

    low: float = 0.002
    high: float = 0.2
    parts: tuple[float, ...] = (0.3, 0.1, 0.03, 0.01, 0.003, 0.001)
    subsets: int = 12
    seed: int = 42

    @property
    def size(self) -> int:
        return len(self.parts) * self.subsets


def terms(text: bytes) -> set[bytes]:
    """Distinct lower-cased (A-Z) words without the marks around them."""
    return {word.strip(b".,;:!?\"'()[]") for word in text.lower().split()} - {b""}


@dataclass(frozen=True)
class Lexicon:
    """Terms of the band, sorted, and the terms above it, the rarest first."""

    words: list[bytes]
    above: list[bytes]


def _distinct_texts(docs: DataFrame) -> tuple[DataFrame, int]:
    """One row of each text, and their number. Only texts that have copies may move, and of each but one row.

    ``docs`` must give the same rows in the same order when read again, as a table does.
    """
    rows = docs.select(text_of().alias("text")).withColumn("_row", F.monotonically_increasing_id())
    hashed = rows.withColumn("_a", F.xxhash64("text")).withColumn("_b", F.xxhash64(F.lit(1), "text"))
    groups = Scratch(docs.sparkSession).cut(hashed.groupBy("_a", "_b").agg(F.min("_row").alias("_row"), F.count("*").alias("_n")))
    repeated = groups.where("_n > 1").select("_a")
    seen = marked(hashed.drop("_b"), "_a", repeated)
    firsts = maybe_in(groups.select("_a", "_row"), "_a", repeated).select("_row")
    once_each = maybe_in(seen.where("_maybe").select("text", "_row"), "_row", firsts).join(firsts, "_row", "left_semi").select("text")
    return seen.where("NOT _maybe").select("text").unionByName(once_each), groups.count()


def lexicon(docs: DataFrame, band: Band = Band()) -> list[bytes]:
    """Terms of the band, sorted. Document frequencies are counted over distinct texts, so copies weigh once."""
    return lexicon_and_above(docs, band).words


def lexicon_and_above(docs: DataFrame, band: Band = Band()) -> Lexicon:
    """The lexicon, and the terms above the band: at most (mean distinct terms) / ``band.high`` of them.

    Tasks sum up what they read and send the sums dealt by term and packed; each term's sums meet in one place.
    """
    count = partitions(docs.sparkSession)
    packed_schema = pa.schema([("shard", pa.int32()), ("terms", pa.binary()), ("n", pa.binary())])
    schema = pa.schema([("term", pa.binary()), ("n", pa.int64())])

    def packed(held: dict[bytes, int]) -> Iterator[tuple]:
        by_shard: dict[int, list[bytes]] = {}
        for term in sorted(held):
            by_shard.setdefault(xxhash.xxh32_intdigest(term) % count, []).append(term)
        for shard, words in by_shard.items():
            data = b"\n".join(words)
            yield (shard, len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True),
                   np.array([held[word] for word in words], "<u4").tobytes())

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held: dict[bytes, int] = {}
            for part in parts:
                for value in utf8(part.column(0)):
                    for term in terms(value):
                        held[term] = held.get(term, 0) + 1
                if len(held) > 400_000:  # bounded memory: what a task says twice is added up
                    yield from packed(held)
                    held = {}
            yield from packed(held)

        return batches(rows(), packed_schema, size=64)

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for part in parts:
            for words, numbers in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                words = pa.decompress(words[8:], int.from_bytes(words[:8], "little"), codec="zstd", asbytes=True).split(b"\n")
                for word, n in zip(words, np.frombuffer(numbers, "<u4").tolist()):
                    total[word] = total.get(word, 0) + n
        yield from batches(total.items(), schema)

    distinct, size = _distinct_texts(docs)
    texts = distinct.mapInArrow(counted, "shard int, terms binary, n binary")
    counts = texts.repartitionById(count, "shard").mapInArrow(summed, "term binary, n long")
    found = [(row["n"], bytes(row["term"])) for row in counts.where(F.col("n") > band.low * size).collect()]
    most = max(1.0, band.high * size)
    return Lexicon(sorted(term for n, term in found if n <= most), [term for _, term in sorted(pair for pair in found if pair[0] > most)])


class Printer:
    """Fingerprints texts against a fixed lexicon."""

    def __init__(self, words: list[bytes], band: Band, above: list[bytes] = ()):
        self.band, self.above, self.others = band, {word: i for i, word in enumerate(above)}, {}
        self.known: dict[bytes, str] = {}
        self.places = {word: i for i, word in enumerate(words)}
        self.hashes = np.array([xxhash.xxh64_intdigest(word, band.seed) for word in words], dtype="<u8")
        self.members = self._drawn(words)

    def _drawn(self, words: list[bytes]) -> np.ndarray:
        """Which subset (row) has which word; drawn by the word alone, so that words outside the lexicon have their subsets too.

        A word has one random place on a circle for each share, and the subsets of that share are arcs of this length,
        evenly begun: they overlap as little as they can, so no word is in many of them while others are in none.
        """
        rows = []
        hashes = np.array([xxhash.xxh64_intdigest(word, self.band.seed) for word in words], dtype=np.uint64)
        for share in self.band.parts:
            place = (hashes ^ np.uint64(xxhash.xxh64_intdigest(f"{self.band.seed}/{share}"))) * _MIX[0]
            place = (place ^ (place >> np.uint64(29))) * _MIX[1]
            begins = (np.arange(self.band.subsets, dtype=np.uint64) * np.uint64(2 ** 64 // self.band.subsets))[:, None]
            rows.append(place[None, :] - begins >> np.uint64(32) < np.uint64(share * 2 ** 32))
        return np.concatenate(rows)

    def _filled(self, words: set[bytes], found: np.ndarray, more: int) -> tuple[np.ndarray, np.ndarray]:
        """Members and hashes of the found terms and of ``more`` on either side of the band: from those above it the
        rarest, from those below it, whose frequencies nobody keeps, the least hashes, which edits seldom change."""
        hashed = lambda word: (xxhash.xxh64_intdigest(word, self.band.seed), word)
        rest = sorted(words & self.above.keys(), key=self.above.get)[:more]
        rest += sorted((word for word in words if word not in self.places and word not in self.above), key=hashed)[:more]
        if len(self.others) > 50_000:
            self.others = {}
        new = [word for word in rest if word not in self.others]
        if new:
            self.others.update(zip(new, self._drawn(new).T))
        hashes = np.concatenate([self.hashes[found], np.array([xxhash.xxh64_intdigest(word, self.band.seed) for word in rest], dtype="<u8")])
        seen = np.concatenate([self.members[:, found], *[self.others[word][:, None] for word in rest]], axis=1)
        order = np.argsort(hashes, kind="stable")
        return seen[:, order], hashes[order]

    def fingerprint(self, text: bytes) -> str:
        """Per subset one hex digit with the number of its terms in the text (up to 15) and seven of the hash of these
        terms, distinct and sorted; dashes where there are none. A text with few terms of the lexicon is known by some of
        its other terms too, one without any word by its own hash."""
        key = xxhash.xxh3_128_digest(text)
        if key not in self.known:
            if len(self.known) >= KEPT_PRINTS:
                self.known = {}
            self.known[key] = self._print(text)
        return self.known[key]

    def _print(self, text: bytes) -> str:
        get, words = self.places.get, terms(text)
        found = {get(word) for word in words}
        found.discard(None)
        if not words:
            return EMPTY * len(self.members) + xxhash.xxh128_hexdigest(text)
        found = np.fromiter(sorted(found), np.int64, len(found))
        # in the order of hashes, so that equal sets of terms agree whether or not texts were filled up
        found = found[np.argsort(self.hashes[found], kind="stable")]
        more = min(MOST, max(FEWEST, len(words) // 2) - len(found))
        seen, hashes = self._filled(words, found, more) if more > 0 else (self.members[:, found], self.hashes[found])
        return "".join([f"{min(n, 15):x}" + xxhash.xxh32_hexdigest(hashes[row].tobytes())[1:] if n else EMPTY
                        for row, n in zip(seen, seen.sum(axis=1).tolist())])


def likeness(a: str, b: str) -> float:
    """Weighted share of equal hashes, 0 to 1; 1 for equal fingerprints.

    Subsets with no term in either text say nothing. A hash of many terms seldom survives an edit, so each further term
    halves its weight; hashes of single terms meet as often as the two sets of terms overlap.
    """
    if a == b:
        return 1.0
    same = total = 0.0
    for at in range(0, min(len(a), len(b)) // 8 * 8, 8):
        x, y = a[at:at + 8], b[at:at + 8]
        if x != EMPTY or y != EMPTY:
            weight = 0.5 ** max(0 if z == EMPTY else int(z[0], 16) - 1 for z in (x, y))
            total += weight
            same += weight * (x == y)
    return same / total if total else 0.0


def fingerprints(docs: DataFrame, band: Band = Band(), words: list[bytes] | None = None) -> DataFrame:
    """``doc_id, fingerprint`` of every document, in one pass; equal texts have equal fingerprints."""
    known = lexicon_and_above(docs, band) if words is None else Lexicon(words, [])

    def made(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Printer(known.words, band, known.above)
        for part in parts:
            found = [printer.fingerprint(value) for value in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", text_of().cast("binary").alias("text")).mapInArrow(made, "doc_id long, fingerprint string")


def in_order_with_next(docs: DataFrame) -> DataFrame:
    """``_slice, _extra, doc_id, text`` dealt to tasks by descending ``doc_id``, each slice followed by the row after it.

    Slices are ranges of ids of about equal size (nulls come last). The first row of each slice, found from the ids
    alone, is also sent to the slice before it, marked ``_extra``; the first row of all goes to the last slice. So each
    task sees the successor of each of its rows and no text moves twice. Repeated ids are ordered by text.
    """
    count = partitions(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text"))
    steps = [i / count for i in range(1, count)]
    bounds = sorted(set(rows.select("doc_id").agg(F.percentile_approx("doc_id", F.array(*[F.lit(s) for s in steps]), F.lit(100 * count))).first()[0] or [])) if steps else []
    # Slice 0 has the largest ids; one slice more for null ids.
    above = F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b >= F.col("doc_id"))), F.lit(0)) if bounds else F.lit(0)
    piece = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(above).cast("int")
    first = {row["_slice"]: (row["id"], row["n"]) for row in rows.select("doc_id", piece.alias("_slice")).groupBy("_slice").agg(
        F.max("doc_id").alias("id"), F.count("*").alias("n")).collect()}
    slices = sorted(first)
    extra = F.lit(None).cast("int")
    for at, number in enumerate(slices):
        leads = F.col("doc_id").eqNullSafe(F.lit(first[number][0])) & (F.col("_slice") == number)
        extra = F.when(leads, F.lit(slices[at - 1])).otherwise(extra)
    both = rows.withColumn("_slice", piece).withColumn("_also", extra)
    both = both.select("doc_id", "text", F.explode(F.array(F.struct(F.col("_slice").alias("s"), F.lit(False).alias("x")),
                                                            F.struct(F.col("_also").alias("s"), F.lit(True).alias("x")))).alias("_p"))
    both = both.where("_p.s IS NOT NULL").select(F.col("_p.s").alias("_slice"), F.col("_p.x").alias("_extra"), "doc_id", "text")
    return both.repartitionById(max(1, len(bounds) + 2), "_slice").sortWithinPartitions("_slice", "_extra", F.desc_nulls_last("doc_id"), "text")


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the following one."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def compared_with_next(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """Each document's fingerprint next to those of its edited text and of the next document (descending ``doc_id``,
    after the last the first), with the two likenesses.

    A single document is its own next one. Repeated ids follow each other by text; null ids come last.
    """
    known = lexicon_and_above(docs, band)
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    kinds = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                       ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Printer(known.words, band, known.above)

        def rows():
            held, done = None, None  # the row that waits for its successor, and the slice that has met its extra rows
            for part in parts:
                for piece, extra, doc_id, text in zip(*(column.to_pylist() for column in part.columns)):
                    if piece == done:
                        continue  # more rows of the first id of the next slice
                    mark = printer.fingerprint(text.encode())
                    if held is not None:
                        before_id, before, before_mark = held
                        changed = edited(before, text)
                        data = changed.encode()
                        changed_mark = printer.fingerprint(data)
                        yield (before_id, len(before), hashlib.sha256(data).hexdigest(), before_mark, changed_mark,
                               likeness(before_mark, changed_mark), likeness(before_mark, mark))
                    held, done = (None, piece) if extra else ((doc_id, text, mark), None)

        yield from batches(rows(), kinds)

    return in_order_with_next(docs).mapInArrow(compared, schema)
