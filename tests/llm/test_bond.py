"""Vertical scan against SQL and against all scores."""

import math
import random

import numpy as np
import pytest

from lakesync.llm import bond
from lakesync.llm.queries import ORACLES, QUERIES
from tests.conftest import SF
from tools.compare import connect, differences


def plain(rows, mining=bond.Mining(), every=100):
    """[(vec_id, label, vector)] -> the rows of hard_negatives"""
    fine = [(i, label, [math.floor(256 * max(-2.0**40, min(2.0**40, x))) for x in v]) for i, label, v in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fine = [(i, label, [max(-bond.LARGEST, min(bond.LARGEST, x)) for x in v]) for i, label, v in fine]
    out = []
    for at, (anchor, label, v) in enumerate(fine):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i is None, i or 0, other == label) for n, (i, other, w) in enumerate(fine) if n != at]
        for p in sorted(s for s in scored if s[3])[:mining.positives]:
            negatives = sorted(s for s in scored if not s[3] and mining.least * -p[0] <= 100 * -s[0] <= mining.most * -p[0])
            out += [(anchor, None if p[1] else p[2], rank, None if n[1] else n[2], -p[0], -n[0]) for rank, n in enumerate(negatives[:mining.negatives], 1)]
    return out


def test_query_matches_sql(spark):
    assert differences(spark, connect(SF), QUERIES["op12_vertical_negatives"], ORACLES["op12_vertical_negatives"], SF) == ""


def test_hard_rows(spark):
    rng = random.Random(3)
    vector = lambda n: [rng.gauss(0.02, 0.2) for _ in range(n)]
    same = vector(12)
    rows = [(n, rng.randrange(3), vector(12)) for n in range(180)] + [(200 + n, n % 2, same) for n in range(60)] + [(n % 4, 1, same) for n in range(9)]
    rows += [(None, 1, same), (None, 2, vector(12)), (None, None, same), (300, None, same), (301, 1, None), (400, 1, [0.1, None] + same[2:]),
             (500, 1, [math.nan] * 12), (501, 2, [math.inf] + same[1:]), (600, 2, []), (601, 2, []), (700, 1, same[:5]), (701, 1, same + [3.0, 4.0]),
             (800, 2, [1e30, -1e38] + same[2:]), (801, 2, [1e30] + same[1:]), (-100, 1, [-x for x in same]), (100, 1, vector(12)), (100, 1, vector(12)), (900, 9, same)]
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows], "vec_id long, label int, embedding array<double>, row int, rank string").repartition(3)
    got = [tuple(r) for r in bond.hard_negatives(frame).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr) and len(got) > 100
    assert bond.hard_negatives(frame.limit(0)).count() == 0
    small = bond.Mining(positives=2, negatives=3, least=0, most=99)
    got = [tuple(r) for r in bond.hard_negatives(frame, small, every=7).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows, small, 7), key=repr)


def test_anchors_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(bond, "ANCHOR_VALUES", 64 * 3)
    rows = [(int(n), int(n % 3), [float(x) for x in v]) for n, v in enumerate(np.random.default_rng(4).normal(0.05, 0.3, (120, 6)))]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in frame.collect()]
    assert sorted(tuple(r) for r in bond.hard_negatives(frame, every=10).collect()) == sorted(plain(rows, every=10))


@pytest.mark.parametrize("scale", [1, 300, 100_000])
def test_scan_drops_only_what_cannot_matter(scale):
    """The bounds let the first rows through, in each number format, and leave out most of the others."""
    rng = np.random.default_rng(scale)
    centres = rng.normal(0, 90, (8, 32))
    labels = rng.integers(0, 8, 4000)
    vectors = (scale * (centres[labels] * np.linspace(2, 0.1, 32) + rng.normal(0, 12, (4000, 32)))).astype(np.int64)
    width = 2 if scale == 1 else 4
    block = bond.Block(np.arange(4000).tobytes(), np.arange(4000).tobytes(), np.ones(4000, bool).tobytes(), labels.tobytes(), 32, width, vectors.T.astype(f"i{width}").tobytes())
    left = 0
    for n in range(0, 4000, 200):
        anchor, scores = bond.Anchor(n, n, int(labels[n]), vectors[n]), vectors @ vectors[n]
        best = bond.Best(5)
        bond.best_of_label(anchor, block, best)
        want = sorted((-int(scores[m]), m) for m in range(4000) if m != n and labels[m] == labels[n])[:5]
        assert [(-s, i) for s, i in best.rows()] == want
        ranges, bests = [bond.Mining().window(s) for s, _ in best.rows()], [bond.Best(10) for _ in range(5)]
        bond.best_in_windows(anchor, block, ranges, bests)
        for (least, most), some in zip(ranges, bests):
            assert [(-s, i) for s, i in some.rows()] == sorted((-int(scores[m]), m) for m in range(4000) if labels[m] != labels[n] and least <= scores[m] <= most)[:10]
        kept = anchor.scan(block, np.ones(4000, bool), lambda score, low, high: score + high >= ranges[0][1])
        left += len(kept[0])
    assert left < 20 * 4000 / 2
