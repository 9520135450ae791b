"""Packing: every token once, little padding, and cuts as cheap as the best ones."""

import random

import numpy as np

from lakesync.llm import packing
from lakesync.llm.queries import word_bpe
from tests.conftest import SF
from tests.llm.brute import check_pieces
from tests.llm.test_bpe import HARD, ids_of


def best_cost(places, penalties, costs, rest):
    """All ways to cut, by the plain recurrence."""
    spots, total = [0, *places], [0]
    for i in range(1, len(spots)):
        total.append(min(total[j] + costs.length - (spots[i] - spots[j]) for j in range(i) if spots[i] - spots[j] <= costs.length) + penalties[i - 1])
    return min(total[j] + rest(spots[-1] - spots[j]) for j in range(len(spots)) if spots[-1] - spots[j] <= costs.length)


def test_cuts_cost_no_more_than_the_best():
    costs, rng = packing.Costs(length=64, sentence=3, inside=9), random.Random(3)
    for rest in (lambda size: 0, lambda size: packing.tail_cost(size, costs)):
        for _ in range(60):
            places = np.cumsum([rng.randint(1, 40) for _ in range(rng.randint(1, 40))])
            penalties = np.array([rng.choice([0, 3, 9]) for _ in places])
            ends = packing.cuts(places, penalties, costs, rest)
            assert all(b - a <= costs.length for a, b in zip([0, *ends], ends))
            penalty = dict(zip(places.tolist(), penalties.tolist()))
            left = int(places[-1]) - (ends[-1] if ends else 0)
            cost = sum(penalty[b] + 64 - (b - a) for a, b in zip([0, *ends], ends)) + rest(left)
            assert left <= costs.length and cost == best_cost(places.tolist(), penalties.tolist(), costs, rest)


def test_long_and_short_documents_in_runs(monkeypatch):
    monkeypatch.setattr(packing, "RUN", 1000)
    costs, rng = packing.Costs(length=256), np.random.default_rng(1)
    docs = [(i, rng.integers(0, 50, n).astype("<u4")) for i, n in enumerate([1, 5000, 1, 1, 999, 1001, 256, 30, 12345, 2])]
    pieces, ends = [], np.arange(50) == 7
    for number, parts in enumerate(packing.sequences(iter(docs), ends, costs)):
        offset = 0
        for doc_id, start, ids, whole in parts:
            pieces.append({"doc_id": doc_id, "start": start, "length": len(ids), "ids": ids, "doc_tokens": whole, "sequence_id": number,
                           "offset": offset, "ids_crc32": __import__("zlib").crc32(ids.tobytes())})
            offset += len(ids)
    assert check_pieces(pieces, {i: [ids] for i, ids in docs}, 256) < 0.2
    assert [p["doc_id"] for p in pieces] == sorted(p["doc_id"] for p in pieces)  # the order stays
    assert list(packing.sequences(iter([]), ends, costs)) == []


def test_hard_texts(spark):
    rows = [(i // 2 if i else None, t) for i, t in enumerate(HARD)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, slice int")
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append([*ids_of(t), 2])
    check_pieces([r.asDict() for r in packing.pack(docs, word_bpe()).collect()], want)
    assert packing.pack(docs.limit(0), word_bpe()).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r[0]: [[*ids_of(r[1]), 2]] for r in docs.select("doc_id", "text").collect()}
    assert check_pieces([r.asDict() for r in packing.pack(docs, word_bpe()).collect()], want) < 0.03
