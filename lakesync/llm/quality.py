"""Quality classifier: a generalised additive model with pairwise interactions over features of a text.

Cyclic boosting adds one shallow tree at a time to the lookup table of one feature, round by round over all features;
then the strongest pairs get tables of their own the same way. A text is scored by binning its features and adding up
table entries.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lakesync.llm.shared import utf8

FEATURES = ("log_words word_bytes upper digits shouts marks beyond_ascii distinct_words distinct_pairs repeated_lines "
            "log_lines line_words short_words log_longest top_word").split()

#: Class of each byte: upper, lower, digit, shout, other mark, beyond ASCII, blank.
_CLASS = bytes(ord("u") if 65 <= b <= 90 else ord("l") if 97 <= b <= 122 else ord("d") if 48 <= b <= 57 else ord("s") if b in b"!?"
               else ord("x") if b >= 128 else ord("b") if b <= 32 else ord("m") for b in range(256))


def features(text: bytes) -> list[float]:
    """The features of one UTF-8 text, all of it; zeros where a text has no words."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    kinds, size, n = text.translate(_CLASS), len(text), len(words)
    upper, lower = kinds.count(b"u"), kinds.count(b"l")
    lines = [line for line in text.split(b"\n") if line.strip()]
    counts = Counter(words)
    lengths = sum(map(len, words))
    return [math.log1p(n), lengths / n, upper / max(1, upper + lower), kinds.count(b"d") / size, kinds.count(b"s") / size,
            kinds.count(b"m") / size, kinds.count(b"x") / size, len(counts) / n,
            len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 1.0, 1 - len(set(lines)) / len(lines),
            math.log1p(len(lines)), n / len(lines), sum(c for w, c in counts.items() if len(w) <= 3) / n,
            math.log1p(max(map(len, counts))), max(counts.values()) / n]


@dataclass
class Model:
    """Bin edges and tables: ``tables[j]`` by feature, ``pairs`` as (j, k, table over coarse bins)."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        logit = np.full(len(rows), self.intercept)
        for j, table in enumerate(self.tables):
            logit += table[np.searchsorted(self.edges[j], rows[:, j], side="right")]
        for j, k, table in self.pairs:
            logit += table[np.searchsorted(self.coarse[j], rows[:, j], side="right"), np.searchsorted(self.coarse[k], rows[:, k], side="right")]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _leaf(g: float, h: float) -> float:
    return g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins in two."""
    if len(g) < 2:
        return 0.0, 0
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = a * a / (b + 1) + (g.sum() - a) ** 2 / (h.sum() - b + 1) - g.sum() ** 2 / (h.sum() + 1)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of a tree with up to three leaves."""
    leaves = [(0, len(g))]
    for _ in range(2):
        gain, at, leaf = max((*_cut(g[a:b], h[a:b]), (a, b)) for a, b in leaves)
        if gain <= 1e-9:
            break
        leaves.remove(leaf)
        leaves += [(leaf[0], leaf[0] + at), (leaf[0] + at, leaf[1])]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts both features of a pair once."""
    best, value = 0.0, np.zeros_like(g)
    ag, ah = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    for a in range(g.shape[0] - 1):
        for b in range(g.shape[1] - 1):
            parts = [(x[a, b], x[a, -1] - x[a, b], x[-1, b] - x[a, b], x[-1, -1] - x[a, -1] - x[-1, b] + x[a, b]) for x in (ag, ah)]
            gain = sum(p * p / (q + 1) for p, q in zip(*parts)) - ag[-1, -1] ** 2 / (ah[-1, -1] + 1)
            if gain > best:
                best, value = gain, np.zeros_like(g)
                for (p, q), place in zip(zip(*parts), (np.s_[:a + 1, :b + 1], np.s_[:a + 1, b + 1:], np.s_[a + 1:, :b + 1], np.s_[a + 1:, b + 1:])):
                    value[place] = _leaf(p, q)
    return best, value


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = 120, pairs: int = 5, rate: float = 0.15, bins: int = 32) -> Model:
    """Fit to features and 0/1 labels. Without rows, or with one label only, every text gets the (smoothed) label rate."""
    mean = (labels.sum() + 0.5) / (len(labels) + 1)
    width = len(FEATURES)
    blank = [np.empty(0)] * width
    model = Model(blank, blank, math.log(mean / (1 - mean)))
    if len(np.unique(labels)) < 2:
        return model
    model.edges = [_edges(rows[:, j], bins) for j in range(width)]
    model.coarse = [_edges(rows[:, j], 8) for j in range(width)]
    codes = [np.searchsorted(model.edges[j], rows[:, j], side="right") for j in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    logit = np.full(len(labels), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-logit))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(codes[j], g, len(table)), np.bincount(codes[j], h, len(table)))
            table += step
            logit += step[codes[j]]
    sizes = [len(e) + 1 for e in model.coarse]
    small = [np.searchsorted(model.coarse[j], rows[:, j], side="right") for j in range(width)]

    def crossed(j, k, weights):
        return np.bincount(small[j] * sizes[k] + small[k], weights, sizes[j] * sizes[k]).reshape(sizes[j], sizes[k])

    g, h = slopes()
    gains = sorted(((_quadrants(crossed(j, k, g), crossed(j, k, h))[0], j, k) for j, k in combinations(range(width), 2)), reverse=True)
    model.pairs = [(j, k, np.zeros((sizes[j], sizes[k]))) for _, j, k in gains[:pairs]]
    for _ in range(rounds // 4):
        for j, k, table in model.pairs:
            g, h = slopes()
            step = rate * _quadrants(crossed(j, k, g), crossed(j, k, h))[1]
            table += step
            logit += step[small[j], small[k]]
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Model:
    """Fit on at most ``sample`` rows, those with the smallest hash of their id.

    Rows whose crc32(doc_id as text) mod 5 is 0 are never learned from; null ids and null labels are not either. A row is
    an id with a label and a text: repeated documents and labels count once, and however many rows share an id, the
    driver gets ``sample`` of them at most.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    chosen = usable.select("doc_id", F.col("quality").cast("int").alias("label")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by sample

    @arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([features(value) for value in utf8(texts)], pa.list_(pa.float64()))

    once_each = rows.select("doc_id", "label", F.xxhash64("text").alias("said"), measured("text").alias("x")).groupBy("doc_id", "label", "said").agg(F.first("x").alias("x"))
    # in an order of its own: the same model for any task order
    found = once_each.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "x").limit(sample).collect()
    found.sort(key=lambda row: (row["doc_id"], row["label"], row["x"]))
    return fit(np.array([row["x"] for row in found]).reshape(-1, len(FEATURES)), np.array([row["label"] for row in found], dtype=float))


def score(model: Model, text: Column | str = "text") -> Column:
    """Score (0 to 1) of a text column; empty and null texts get the score of a text without words."""

    @arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        rows = np.array([features(value) for value in utf8(texts)], dtype=float).reshape(-1, len(FEATURES))
        return pa.array(model.score(rows))

    return scores(F.col(text) if isinstance(text, str) else text)
