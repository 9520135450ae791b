"""Hard negatives by a vertical scan (BOND): dimension by dimension, candidates leave as soon as their bounds say so.

Rows are stored in blocks with one array per dimension. For an anchor a task reads the dimensions of a block in the
order of the anchor's largest magnitudes. After each few of them a row's score is known up to what the other dimensions
can add, at least and at most, by their least and greatest value in the block; rows that can no longer matter lose
their bit. Two scans:

1. The best rows of the anchor's label. A row leaves if it cannot reach the best ones known so far.
2. Rows of other labels, for a window of scores per positive. A row leaves if it cannot get into a window any more, or
   only behind as many rows as are wanted and surely in it. What is left is exact.

Anchors go in blocks of bounded size, each block against all rows: the tasks get the anchors of one block, never more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesync.session import Scratch

#: Rows of a block, and values (rows times dimensions) at most.
BLOCK_ROWS, BLOCK_VALUES = 8192, 1 << 22
#: Values (anchors times dimensions, 64 at least) of a block of anchors: some 4,096 anchors, broadcast as 8 bytes a value.
ANCHOR_VALUES = 1 << 18
#: Dimensions read between two looks at the bounds.
STEP = 4
#: Components are whole numbers and go up to here; larger ones count as this, so that scores fit 64 bits.
LARGEST = 1 << 25


@dataclass(frozen=True)
class Mining:
    """Positives per anchor, negatives per positive, and the window of negative scores as percentages of the positive's."""

    positives: int = 5
    negatives: int = 10
    least: int = 30
    most: int = 90

    def window(self, score: int) -> tuple[int, int]:
        """Whole scores ``s`` with ``least * score <= 100 * s <= most * score``; empty if the first is above the second."""
        return -((-self.least * score) // 100), self.most * score // 100


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a list column in a row, length of each list, and whether it takes part: no null, no infinite, no NaN in it."""
    sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
    flat = column.flatten()
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan), np.float64)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    ends = np.cumsum(sizes)
    return values, sizes, np.asarray(column.is_valid()) & (bad[ends] == bad[ends - sizes])


_BLOCK = "rows binary, ids binary, named binary, labels binary, dims int, width int, values binary"


def blocks(vectors: DataFrame) -> DataFrame:
    """Blocks of ``row, id, label, vector``: vectors as whole numbers, dimension by dimension; shorter ones end in zeros."""

    def closed(held: list[tuple]) -> pa.RecordBatch:
        dims = max(len(vector) for *_, vector in held)
        matrix = np.zeros((dims, len(held)), np.int64)
        for at, (*_, vector) in enumerate(held):
            matrix[:len(vector), at] = vector
        width = 2 if np.abs(matrix).max(initial=0) < 1 << 15 else 4
        data = [np.array([row for row, *_ in held], np.int64), np.array([name or 0 for _, name, *_ in held], np.int64),
                np.array([name is not None for _, name, *_ in held], bool), np.array([label for _, _, label, _ in held], np.int64)]
        return pa.RecordBatch.from_arrays(
            [*(pa.array([array.tobytes()]) for array in data), pa.array([dims], pa.int32()), pa.array([width], pa.int32()),
             pa.array([matrix.astype(f"i{width}").tobytes()])], names=["rows", "ids", "named", "labels", "dims", "width", "values"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, widest = [], 0
        for part in parts:
            values, sizes, fine = _numbers(part.column(3))
            whole = np.clip(np.floor(256 * np.clip(np.nan_to_num(values), -LARGEST, LARGEST)), -LARGEST, LARGEST).astype(np.int64)
            ends = np.cumsum(sizes)
            for row, name, label, a, b, good in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(),
                                                    (ends - sizes).tolist(), ends.tolist(), fine.tolist()):
                if not good or label is None:
                    continue
                widest = max(widest, b - a)
                if held and (len(held) == BLOCK_ROWS or (len(held) + 1) * widest > BLOCK_VALUES):
                    yield closed(held)
                    held, widest = [], b - a
                held.append((row, name, label, whole[a:b]))
        if held:
            yield closed(held)

    return vectors.mapInArrow(run, _BLOCK)


class Block:
    """A stored block: arrays of its rows, and one array per dimension."""

    def __init__(self, rows: bytes, ids: bytes, named: bytes, labels: bytes, dims: int, width: int, values: bytes):
        self.rows, self.ids, self.labels = (np.frombuffer(data, np.int64) for data in (rows, ids, labels))
        self.named = np.frombuffer(named, bool)
        self.values = np.frombuffer(values, f"i{width}").reshape(dims, len(self.rows))
        self.low, self.high = self.values.min(axis=1).astype(np.int64), self.values.max(axis=1).astype(np.int64)
        self.peak = max(1, -int(self.low.min(initial=0)), int(self.high.max(initial=0)))
        self._as: dict[type, np.ndarray] = {}

    def columns(self, kind: type) -> np.ndarray:
        if kind not in self._as:
            self._as[kind] = self.values.astype(kind)
        return self._as[kind]

    @staticmethod
    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        for part in parts:
            for at in range(part.num_rows):
                yield Block(*(part.column(c)[at].as_py() for c in range(7)))


class Anchor:
    """One query row: its numbers by falling magnitude."""

    def __init__(self, row: int, name: int, label: int, vector: np.ndarray):
        self.row, self.name, self.label = row, name, label
        order = np.argsort(-np.abs(vector), kind="stable")
        self.order = order[vector[order] != 0]
        self.numbers = vector[self.order]
        self.peak = int(np.abs(self.numbers).max(initial=0))

    def scan(self, block: Block, candidates: np.ndarray, keeps) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the candidates that ``keeps(low, high)`` never refused."""
        known = self.order < len(block.values)
        order, numbers = self.order[known], self.numbers[known]
        bound = self.peak * block.peak * max(1, len(order))  # of any sum on the way: in floats it stays exact
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
        ends = np.stack((numbers * block.low[order], numbers * block.high[order]))
        rest_low = np.concatenate((np.cumsum(ends.min(axis=0)[::-1])[::-1], [0]))
        rest_high = np.concatenate((np.cumsum(ends.max(axis=0)[::-1])[::-1], [0]))
        columns, at = block.columns(kind), np.flatnonzero(candidates)
        whole = len(at) == len(candidates)
        score = np.zeros(len(at), kind)
        for first in range(0, len(order), STEP):
            for dim, number in zip(order[first:first + STEP], numbers[first:first + STEP]):
                score += columns[dim] * kind(number) if whole else columns[dim][at] * kind(number)
            done = min(first + STEP, len(order))
            kept = keeps(score, int(rest_low[done]), int(rest_high[done]))
            if kept is not None and not kept.all():
                at, score, whole = at[kept], score[kept], False
                if not len(at):
                    break
        return at, score.astype(np.int64)


def _kth(values: np.ndarray, k: int) -> int | None:
    """The k-th greatest value, None if there are fewer."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


class Best:
    """The first rows by falling score, ties by smaller id, rows without an id last."""

    def __init__(self, size: int):
        self.size = size
        self.score = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.named = np.empty(0, bool)

    @property
    def least(self) -> int | None:
        """What a further row must reach; None while there is room."""
        return int(self.score[-1]) if len(self.score) == self.size else None

    def add(self, block: Block, at: np.ndarray, score: np.ndarray) -> None:
        if self.least is not None:
            good = score >= self.least
            at, score = at[good], score[good]
        if len(at):
            score = np.concatenate((self.score, score))
            name, named = np.concatenate((self.id, block.ids[at])), np.concatenate((self.named, block.named[at]))
            order = np.lexsort((name, ~named, -score))[:self.size]
            self.score, self.id, self.named = score[order], name[order], named[order]

    def rows(self) -> Iterator[tuple[int, int | None]]:
        for score, name, named in zip(self.score.tolist(), self.id.tolist(), self.named.tolist()):
            yield score, name if named else None


def best_of_label(anchor: Anchor, block: Block, best: Best) -> None:
    """Add the block's rows of the anchor's label that are among the best ones."""
    candidates = (block.labels == anchor.label) & (block.rows != anchor.row)
    if not candidates.any():
        return

    def keeps(score, low, high):
        sure = _kth(score, best.size)
        needed = max((bound for bound in (best.least, None if sure is None else sure + low) if bound is not None), default=None)
        return None if needed is None else score + high >= needed

    best.add(block, *anchor.scan(block, candidates, keeps))


def best_in_windows(anchor: Anchor, block: Block, ranges: list[tuple[int, int]], bests: list[Best]) -> None:
    """Add the block's rows of other labels to the best ones of each window of scores."""
    candidates = block.labels != anchor.label
    if not candidates.any():
        return

    def keeps(score, low, high):
        kept = np.zeros(len(score), bool)
        for (least, most), best in zip(ranges, bests):
            sure = score[(score + low >= least) & (score + high <= most)]
            bound = max((value for value in (least, best.least, _kth(sure, best.size) + low if len(sure) >= best.size else None) if value is not None))
            kept |= (score + high >= bound) & (score + low <= most)
        return kept

    at, score = anchor.scan(block, candidates, keeps)
    for (least, most), best in zip(ranges, bests):
        inside = (score >= least) & (score <= most)
        best.add(block, at[inside], score[inside])


_POSITIVES = "anchor int, score long, id long"
_NEGATIVES = "anchor int, positive int, score long, id long"


def _emitted(rows: list[tuple], kinds: list) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "score", "id"] if len(kinds) == 3 else ["anchor", "positive", "score", "id"]
    for some in range(0, len(rows), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows[some:some + (1 << 16)]), kinds)], names=names)


def _positives(stored: DataFrame, anchors: list[tuple], mining: Mining) -> DataFrame:
    shared = stored.sparkSession.sparkContext.broadcast(anchors)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [(Anchor(*anchor), Best(mining.positives)) for anchor in shared.value]
        for block in Block.read(parts):
            for anchor, best in mine:
                best_of_label(anchor, block, best)
        yield from _emitted([(n, *row) for n, (_, best) in enumerate(mine) for row in best.rows()], [pa.int32(), pa.int64(), pa.int64()])

    rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return stored.mapInArrow(run, _POSITIVES).withColumn("rank", rank).where(F.col("rank") <= mining.positives)


def _negatives(stored: DataFrame, anchors: list[tuple], ranges: list[list[tuple[int, int]]], mining: Mining) -> DataFrame:
    shared = stored.sparkSession.sparkContext.broadcast((anchors, ranges))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [(Anchor(*anchor), [(n, r) for n, r in enumerate(own) if r[0] <= r[1]]) for anchor, own in zip(*shared.value)]
        bests = [[Best(mining.negatives) for _ in own] for _, own in mine]
        for block in Block.read(parts):
            for (anchor, own), best in zip(mine, bests):
                if own:
                    best_in_windows(anchor, block, [r for _, r in own], best)
        rows = [(n, at, *row) for n, ((_, own), best) in enumerate(zip(mine, bests)) for (at, _), one in zip(own, best) for row in one.rows()]
        yield from _emitted(rows, [pa.int32(), pa.int32(), pa.int64(), pa.int64()])

    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return stored.mapInArrow(run, _NEGATIVES).withColumn("rank", rank.cast("int")).where(F.col("rank") <= mining.negatives)


def _anchors(stored: DataFrame, every: int) -> DataFrame:
    """``row, id, label, vector`` of the rows whose id is divisible by ``every``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in Block.read(parts):
            at = np.flatnonzero(block.named & (block.ids % every == 0))
            if len(at):
                vectors = [np.ascontiguousarray(block.values[:, n], np.int64).tobytes() for n in at]
                yield pa.RecordBatch.from_arrays([pa.array(block.rows[at]), pa.array(block.ids[at]), pa.array(block.labels[at]), pa.array(vectors)],
                                                 names=["row", "id", "label", "vector"])

    return stored.mapInArrow(run, "row long, id long, label long, vector binary")


def hard_negatives(vectors: DataFrame, mining: Mining = Mining(), every: int = 100, scratch: Scratch | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vec_id, label, embedding`` rows.

    Components count as ``floor(256 * x)``, scores are whole inner products. Anchors are the rows whose id is divisible
    by ``every``; their positives are the best other rows of the label. Each pair gets the best rows of other labels
    whose score is in the window, ranked from 1; ties go by smaller id, and a window that is empty, as for a negative
    positive score, gives no rows.

    Rows with a null label, a null vector, or a null, NaN or infinite component take no part. Rows with a null id do:
    they are no anchors and come last among ties. Of vectors of different length the shorter one ends in zeros.
    Components beyond 2**25 count as 2**25. Rows that repeat an id are rows of their own, as anchors, positives and
    negatives. An empty table gives no rows. Other columns are not read.
    """
    scratch = scratch or Scratch(vectors.sparkSession)
    stored = scratch.cut(blocks(vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"),
                                               F.col("embedding").cast("array<double>"))))
    queries = _anchors(stored, every)
    size = queries.agg(F.count("*").alias("n"), F.max(F.length("vector")).alias("widest")).first()
    count = math.ceil(size["n"] * max(64, (size["widest"] or 0) // 8) / ANCHOR_VALUES)
    queries = scratch.cut(queries.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(max(1, count)))))
    found = []
    for part in range(count):
        anchors = [(r["row"], r["id"], r["label"], np.frombuffer(r["vector"], np.int64)) for r in queries.where(F.col("part") == part).collect()]
        if not anchors:
            continue
        positives: list[list[tuple]] = [[] for _ in anchors]
        for row in _positives(stored, anchors, mining).orderBy("anchor", "rank").collect():  # a few for each anchor of the block
            positives[row["anchor"]].append((row["id"], row["score"]))
        ranges = [[mining.window(score) for _, score in own] for own in positives]
        names = [(n, at, anchor[1], name, score) for n, (anchor, own) in enumerate(zip(anchors, positives)) for at, (name, score) in enumerate(own)]
        schema = "anchor int, positive int, anchor_id long, positive_id long, positive_score long"
        named = vectors.sparkSession.createDataFrame(names, schema)
        negatives = _negatives(stored, anchors, ranges, mining).join(F.broadcast(named), ["anchor", "positive"])
        found.append(scratch.cut(negatives.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                                                  F.col("score").alias("negative_score"))))
    out = vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for some in found:
        out = out.unionByName(some)
    return out
