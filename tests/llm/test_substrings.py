"""Substring dedup against brute force."""

import random
import tracemalloc

import pyarrow as pa

from lakesync.llm import substrings
from lakesync.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.brute import passages_removed, sha


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op4_repeated_passages"](spark, SF).collect())
    assert got == sorted((i, n, gone, sha(" ".join(kept))) for i, n, gone, kept in passages_removed(rows))


def test_hard_rows(spark):
    rng = random.Random(2)
    pool = [f"w{n}é" for n in range(40)]
    shared = [" ".join(rng.choice(pool) for _ in range(30)) for _ in range(4)]
    rows = [(1, shared[0]), (2, f"pre {shared[0]}\n\tpost"), (2, shared[0]), (3, None), (3, ""), (None, shared[0]), (None, shared[1]), (4, shared[1]),
            (5, " ".join(shared[0].split()[:12])), (6, " ".join(shared[0].split()[:13])), (7, f"{shared[2]} {shared[3]}"), (8, f"{shared[3]} {shared[2]}"),
            (9, "a " * 4000), (10, "a " * 15), (11, "a " * 12), (-5, f"{shared[3][4:]} {'z' * 9000}"), (12, "日本 " * 14), (13, "日本　" * 20 + " 日本" * 13)]
    rows += [(20 + n, " ".join(rng.choice(pool[:3]) for _ in range(60))) for n in range(30)]
    docs = spark.createDataFrame([(i, t, "k", 3) for i, t in rows], "doc_id long, text string, block string, n_words int")
    found = substrings.dedup(docs)
    assert found.columns == ["doc_id", "text", "block", "n_words", "n_removed"]
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], " ".join((r["text"] or "").encode().decode().split(" ")).split() if r["n_removed"] else None) for r in found.collect()), key=repr)
    want = sorted(((i, n, gone, " ".join(kept).split() if gone else None) for i, n, gone, kept in passages_removed(rows)), key=repr)
    assert got == want
    assert {r["text"] for r in found.where("doc_id IS NULL").collect()} == {shared[0], shared[1]}
    assert substrings.dedup(docs.limit(0)).count() == 0


def test_choosing_phrases_takes_few_copies_of_the_words():
    """Eight hashes a window were copied at once, which in a worker of the pipeline was too much memory."""
    rng = random.Random(3)
    texts = pa.array([" ".join(f"w{rng.randrange(50)}" for _ in range(20_000)) for _ in range(10)] + ["", None, "a " * 500])
    words = substrings.Words(texts, 13)
    tracemalloc.start()
    hashes, least = words.chosen_phrases(6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 7 * words.values.nbytes
    assert least.tolist() == [at + hashes[at:at + 8].argmin() for at in words.starts.tolist()]
