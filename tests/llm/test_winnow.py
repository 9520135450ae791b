"""Winnowing against SQL and against a plain search for every window."""

import random
import re

import pyarrow as pa
import pytest

from lakesync.llm import winnow
from lakesync.llm.queries import ORACLES, QUERIES
from tests.conftest import SF
from tests.llm.brute import sha
from tools.compare import connect, differences


def words_of(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    """[(doc_id, text)], [(item_id, text)] -> [(doc_id, n_words, hit words, item digest, number of items)]"""
    wanted = {}
    for item, text in items:
        words = words_of(text)
        size = min(10, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            wanted.setdefault(tuple(words[at:at + size]), set()).add(item)
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in wanted}:
            for at in range(len(words) - size + 1):
                if (names := wanted.get(tuple(words[at:at + size]))) is not None:
                    hit.update(range(at, at + size))
                    found |= names
        names = sorted(str(n) for n in found if n is not None)
        out.append((doc_id, len(words), tuple(sorted(hit)), len(names), sha(",".join(names))))
    return out


def covered(row):
    return tuple(at for r in row["ranges"] or [] for at in range(r["start"], r["stop"]))


def test_query_matches_sql(spark):
    assert differences(spark, connect(SF), QUERIES["op11_winnowed_leaks"], ORACLES["op11_winnowed_leaks"], SF) == ""


def test_hard_rows(spark):
    rng = random.Random(5)
    pool = [f"w{n}" for n in range(12)] + ["é", "ABC", "日本", "İ"]
    prose = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    common = prose(14)
    items = [(n, prose(rng.choice([1, 2, 3, 5, 9, 10, 11, 30]) + 4 * (n % 2))) for n in range(20)]
    items += [(100 + n, f"{common} {prose(5)}") for n in range(30)] + [(3, common), (3, common), (None, "only the nameless one"), (None, None), (50, ""), (51, "?!"), (52, "zz")]
    docs = [(n, f"{prose(20)}, {rng.choice(items)[1]}! {prose(20)}") for n in range(40)] + [(40 + n, f"{common.upper()}\n\n{prose(3)}") for n in range(30)]
    docs += [(None, common), (None, None), (1, ""), (1, " .,"), (1, "zz-ZZ\x00zz"), (7, "only the... nameless\tONE"), (8, f"{common[:-1]}"), (9, "x" * 5000 + " zz"), (10, "a " * 30000 + common)]
    # touching texts must not flow into each other
    docs += [(11, " ".join(common.split()[:7])), (12, " ".join(common.split()[7:]))]
    frame = spark.createDataFrame([(i, t, 1, "k", "r") for i, t in docs], "doc_id long, text string, n_words int, windows string, row string").repartition(3)
    bench = spark.createDataFrame([(i, t, 2, b"k") for i, t in items], "item_id long, text string, span int, key binary")
    got = [(r["doc_id"], r["n_words"], covered(r), r["n_items"], r["items_sha256"]) for r in winnow.decontaminate(frame, bench).collect()]
    assert sorted(got, key=repr) == sorted(plain(docs, items), key=repr)
    assert sum(bool(g[2]) for g in got) > 60
    assert winnow.decontaminate(frame.limit(0), bench).count() == 0
    clean = winnow.digest(winnow.decontaminate(frame, bench.limit(0))).collect()
    assert len(clean) == len(docs) and not any(r["contaminated"] or r["n_hit"] or r["n_items"] for r in clean)


@pytest.mark.parametrize("size", [1, 60, 400])
def test_long_texts_in_pieces(monkeypatch, size):
    rng = random.Random(size)
    texts = [" ".join(rng.choice(["ab", "C", "d" * 90, "é?"]) for _ in range(rng.choice([0, 1, 4, 9, 10, 60]))) for _ in range(60)]
    whole = winnow.windows(pa.array(texts)), winnow.windows(pa.array(texts), [1, 2, 5, 10])
    monkeypatch.setattr(winnow, "PIECE_BYTES", size)
    pieces = winnow.windows(pa.array(texts)), winnow.windows(pa.array(texts), [1, 2, 5, 10])
    for a, b in zip(whole, pieces):
        assert a[0].tolist() == b[0].tolist() == [len(words_of(t)) for t in texts]
        assert sorted(a[1]) == sorted(b[1]) and len(a[1]) > 60


def test_every_window_keeps_one_fingerprint():
    words = winnow.Words([b"a b a b a b a b a b a b c", " ".join(f"w{n}" for n in range(40)).encode(), b"a a a a a a a a a a a a"])
    for span in range(1, 11):
        prints = words.prints(span)
        starts, places = words.kept(prints, winnow.np.arange(len(prints)), span)
        want = [at for at in range(len(words.begins)) if at + span <= words.last[at]]
        assert sorted(starts.tolist()) == want
        assert len(set(places.tolist())) <= len(want)
