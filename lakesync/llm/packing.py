"""Packing documents into sequences of bounded length without changing their order.

Cuts are chosen by dynamic programming over the ends of documents and sentences: the cost of a way to cut is the padding
of its sequences plus a penalty for each cut inside a document. The best start of a sequence that ends at a given place
is the least value in a sliding window, kept in a monotone queue, so a place costs constant time.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm import bpe
from lakesync.llm.shared import batches, partitions

#: Tokens cut at a time; what the last sequence holds goes on to the next run.
RUN = 1 << 18


@dataclass(frozen=True)
class Costs:
    """Sequence length, and the penalty of a cut at a sentence end or anywhere else, in tokens of padding."""

    length: int = 4096
    sentence: int = 8
    inside: int = 32
    end_id: int = 2


def padding(size: int, length: int) -> int:
    """Tokens of padding: none at a power of two."""
    return 0 if size & (size - 1) == 0 else length - size


def cuts(places: np.ndarray, penalties: np.ndarray, costs: Costs, rest: Callable[[int], int]) -> list[int]:
    """Places where whole sequences end; what is left after the last one costs ``rest`` of its size.

    ``places`` ascend from above 0 and lie at most a length apart.
    """
    length = costs.length
    spots, before, total = [0, *places.tolist()], [0] * (len(places) + 1), [0]
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # (cost so far + place, place, number), ascending in all
    for number, (spot, penalty) in enumerate(zip(spots[1:], penalties.tolist()), 1):
        least = spot - length
        while queue[0][1] < least:
            queue.popleft()
        first = queue[0]
        before[number] = first[2]
        value = first[0] + length + penalty  # the cost of a sequence that ends here, + spot
        total.append(value - spot)
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, spot, number))
    last = len(spots) - 1
    first = int(np.searchsorted(spots, spots[-1] - length))
    number = min(range(last, first - 1, -1), key=lambda n: total[n] + rest(spots[-1] - spots[n]))
    found = []
    while number:
        found.append(spots[number])
        number = before[number]
    return found[::-1]


def candidates(held: list[tuple], ends: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Places one may cut at with their penalties: document ends, sentence ends, and enough others in long sentences."""
    ids = np.concatenate([part[3] for part in held])
    doc_ends = np.cumsum([len(part[3]) for part in held])
    kind = np.where(ends[np.minimum(ids, len(ends) - 1)], costs.sentence, costs.inside + 1)
    kind[doc_ends - 1] = 0
    places = np.flatnonzero(kind <= costs.inside) + 1
    gaps = np.diff(places, prepend=0)
    step = max(1, costs.length // 64)
    wide = np.flatnonzero(gaps > step)
    more = [np.arange(places[i] - gaps[i] + step, places[i], step) for i in wide]
    if more:
        places = np.union1d(places, np.concatenate(more))
    return places, np.minimum(kind[places - 1], costs.inside)


def tail(size: int, costs: Costs) -> list[int]:
    """Sizes the last stretch is split into: powers of two, unless padding it costs less than the cuts."""
    if padding(size, costs.length) <= costs.inside * (size.bit_count() - 1):
        return [size] if size else []
    return [1 << bit for bit in range(size.bit_length() - 1, -1, -1) if size >> bit & 1]


def tail_cost(size: int, costs: Costs) -> int:
    return min(padding(size, costs.length), costs.inside * max(0, size.bit_count() - 1))


def sequences(rows: Iterator[tuple], ends: np.ndarray, costs: Costs) -> Iterator[list[tuple]]:
    """Pieces (doc_id, start, ids, doc_tokens) of one sequence after another, from (doc_id, ids) in order."""
    held, size = [], 0  # (doc_id, start, doc_tokens, ids)

    def taken(until: list[int], parts: list[tuple]) -> tuple[list[list[tuple]], list[tuple]]:
        out, parts, at = [], deque(parts), 0
        for end in until:
            room, pieces = end - at, []
            while room:
                doc_id, start, whole, ids = parts.popleft()
                if len(ids) > room:
                    parts.appendleft((doc_id, start + room, whole, ids[room:]))
                    ids = ids[:room]
                pieces.append((doc_id, start, ids, whole))
                room -= len(ids)
            out.append(pieces)
            at = end
        return out, list(parts)

    def run(parts: list[tuple], last: bool) -> tuple[list[list[tuple]], list[tuple]]:
        places, penalties = candidates(parts, ends, costs)
        found = cuts(places, penalties, costs, lambda size: tail_cost(size, costs) if last else 0)
        if last:
            begin = found[-1] if found else 0
            found += (begin + np.cumsum(tail(int(places[-1]) - begin, costs), dtype=np.int64)).tolist()
        return taken(found, parts)

    for doc_id, ids in rows:
        held.append((doc_id, 0, len(ids), ids))
        size += len(ids)
        while size >= RUN:  # a document far longer than a run is cut in several of them
            part, rest, room = [], deque(held), RUN
            while room and rest:
                doc, start, whole, some = rest.popleft()
                if len(some) > room:
                    rest.appendleft((doc, start + room, whole, some[room:]))
                    some = some[:room]
                part.append((doc, start, whole, some))
                room -= len(some)
            done, left = run(part, False)
            yield from done
            if left and rest and left[-1][0] == rest[0][0] and left[-1][1] + len(left[-1][3]) == rest[0][1] and rest[0][1]:
                doc, start, whole, some = left.pop()
                left.append((doc, start, whole, np.concatenate([some, rest.popleft()[3]])))
            held = left + list(rest)
            size = sum(len(item[3]) for item in held)
    if held:
        yield from run(held, True)[0]


@lru_cache(maxsize=2)
def _sentence_ends(spec: str) -> np.ndarray:
    """Ids whose piece ends a word with a full stop, exclamation or question mark."""
    return np.array([piece.endswith((".</w>", "!</w>", "?</w>")) for piece in bpe._pieces(spec)], bool)


def slices(docs: DataFrame) -> tuple[F.Column, int]:
    """Column that deals rows to about equal ranges of ``doc_id`` (nulls first), and the number of ranges."""
    count = partitions(docs.sparkSession)
    steps = [i / count for i in range(1, count)]
    bounds = docs.agg(F.percentile_approx("doc_id", F.array(*[F.lit(s) for s in steps]), F.lit(100 * count))).first()[0] if steps else []
    bounds = sorted(set(bounds or []))
    if not bounds:
        return F.lit(0), 1
    above = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(above).cast("int"), len(bounds) + 1


def pack(docs: DataFrame, spec: str, costs: Costs = Costs()) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``: one row per piece of a document.

    A document is its ids and ``end_id``, so an empty one has one token. Documents go by ``doc_id`` (nulls first, equal
    ids by their tokens) in about equal ranges of ids; each range is packed by itself, with at most a dozen short
    sequences at its end. A task holds one run of tokens at a time, whatever the length of a document or of its range.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    column, count = slices(docs.select("doc_id"))
    dealt = bpe.encode(docs, spec).withColumn("slice", column).repartitionById(count, "slice").sortWithinPartitions("slice", F.asc_nulls_first("doc_id"), "ids")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, here = _sentence_ends(shared.value), [0]

        def documents():
            for part in parts:
                for doc_id, ids, number in zip(*(column.to_pylist() for column in part.columns)):
                    here[0] = number
                    yield doc_id, np.append(np.frombuffer(ids, "<u4"), np.uint32(costs.end_id))

        def rows():
            for number, pieces in enumerate(sequences(documents(), ends, costs)):
                offset = 0
                for doc_id, start, ids, whole in pieces:
                    data = ids.astype("<u4").tobytes()
                    yield doc_id, start, len(ids), crc32(data), whole, (here[0] << 40) + number, offset, ids.astype(np.int32)
                    offset += len(ids)

        return batches(rows(), schema)

    return dealt.mapInArrow(packed, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>")
