"""SimHash groups against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakesync.llm import simhash
from lakesync.llm.components import components
from lakesync.llm.shared import Scratch
from tests.conftest import SF


def plain(text, shingle=3):
    """The rule written out bit by bit."""
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    rows = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in rows]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def grouped(prints):
    """Smallest id reachable over pairs within two bits, by comparing all pairs."""
    ids, fps = zip(*sorted(prints, key=lambda p: (p[0] is None, p[0] or 0)))
    values, parent = np.array(fps, dtype=np.uint64), list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in np.nonzero(np.bitwise_count(values ^ values[i]) <= 2)[0]:
            a, b = sorted((root(i), root(int(j))))
            parent[b] = a
    return sorted(((ids[i], fps[i], ids[root(i)]) for i in range(len(ids))), key=repr)


def test_fingerprints_follow_the_rule():
    for text in ("", " \t\n", "One", "ONE two", "a b c", "a b c d é É", "x " * 500, "Ünd 漢字 A B c d"):
        assert simhash.simhash(text.encode()) == plain(text)


def test_every_pair_within_the_radius_shares_a_bucket():
    for radius in (2, 4):
        tables = simhash.masks(radius)
        rng = random.Random(radius)
        for _ in range(2000):
            diff = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(diff & mask == 0 for mask in tables)


def test_links_connect_exactly_the_near_pairs(spark):
    rng, values = random.Random(5), set()
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(12):
            for _ in range(rng.randint(0, 2)):
                base ^= 1 << rng.randrange(64)
            values.add(base)
    pairs = [(v, v) for v in values]
    signed = [(simhash._signed(v),) for v in values]
    scratch = Scratch(spark)
    roots = components(simhash.links(spark.createDataFrame(signed, "fp long")), scratch).collect()
    groups = {}
    for row in roots:
        groups.setdefault(row["root"], set()).add(row["node"] % 2**64)
    want = {}
    for value, _, first in grouped(pairs):
        want.setdefault(first, set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (100, 101)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def test_groups_of_hard_rows(spark):
    rows = [(1, None), (2, ""), (3, "\n"), (4, "same words here and there"), (5, "SAME words here and there"), (5, "same words here and there"),
            (None, "alone in this text"), (None, None), (6, "w " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    got = sorted(((r[0], int(r[1], 16), r[2]) for r in simhash.near_groups(docs).select("doc_id", "fingerprint", "component_id").collect()), key=repr)
    want = [(i, plain(t)) for i, t in rows]
    assert [g[:2] for g in got] == sorted(want, key=repr)
    assert {(g[0], g[2]) for g in got} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (None, None), (None, 1), (6, 6)}
    assert simhash.near_groups(docs.limit(0)).count() == 0


def test_query_matches_brute_force(spark):
    from lakesync.llm.queries import QUERIES

    got = sorted(((r[0], int(r[1], 16), r[2]) for r in QUERIES["op7_simhash_groups"](spark, SF).collect()), key=repr)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == grouped([(r[0], plain(r[1])) for r in docs])
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 3)
