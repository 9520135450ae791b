"""I-Match: order, edited texts, equal texts, likeness."""

from collections import Counter

import numpy as np
import xxhash

from lakesync.llm import imatch
from lakesync.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.brute import sha


def test_query_follows_the_order(spark):
    docs = sorted((tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()), key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in QUERIES["op2_imatch_prints"](spark, SF).collect()}
    assert len(got) == len(docs)
    for at, (doc_id, text) in enumerate(docs):
        following, third = docs[(at + 1) % len(docs)], len(text) // 3
        row = got[doc_id]
        changed = text[:len(text) - third] + following[1][:third]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), sha(changed))
        assert abs(row["near_next"] - imatch.likeness(row["fingerprint"], got[following[0]]["fingerprint"])) < 1e-12
        assert abs(row["near_edited"] - imatch.likeness(row["fingerprint"], row["edited_fingerprint"])) < 1e-12
        assert 0 <= row["near_next"] <= 1
    near, far = (np.array([row[name] for row in got.values()]) for name in ("near_edited", "near_next"))
    assert np.mean([(n > far).mean() + (n == far).mean() / 2 for n in near]) > 0.93
    prints = {}
    for doc_id, text in docs:
        assert prints.setdefault(text, got[doc_id]["fingerprint"]) == got[doc_id]["fingerprint"]


def test_lexicon_is_the_band(spark):
    rows = [(n, f"every {'half' if n % 2 else 'other'} own{n}") for n in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert imatch.lexicon(docs, imatch.Band(low=0.1, high=0.6)) == [b"half", b"other"]


def test_hard_rows(spark):
    rows = [(5, "alpha beta"), (5, "alpha gamma"), (4, None), (3, ""), (None, "omega"), (None, None), (9, "x " * 40000), (-2, "日本 語")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, _slice string")
    got = imatch.compared_with_next(docs).collect()
    order = [9, 5, 5, 4, 3, -2, None, None]
    texts = ["x " * 40000, "alpha beta", "alpha gamma", "", "", "日本 語", "", "omega"]
    want = {(i, sha(imatch.edited(t, texts[(n + 1) % 8]))) for n, (i, t) in enumerate(zip(order, texts))}
    assert {(r["doc_id"], r["edited_sha256"]) for r in got} == want and len(got) == 8
    assert imatch.compared_with_next(docs.limit(0)).count() == 0
    alone = imatch.compared_with_next(docs.where("doc_id = 9")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert imatch.fingerprints(docs.limit(0)).count() == 0
    known = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprints(docs).collect()}
    assert known[3] == known[4] and imatch.likeness(known[3], known[-2]) == 0


def test_copies_and_rare_languages_keep_fingerprints(spark):
    """A third of all rows is one text, and one text has only terms below the band."""
    rng = np.random.default_rng(3)
    rows = [(n, " ".join(f"w{k}" for k in rng.integers(0, 3000, 60))) for n in range(1000)]
    copied, rare = (" ".join(f"{mark}{k}" for k in range(198)) for mark in ("copied", "rare"))
    rows += [(2000 + n, copied) for n in range(500)] + [(5000, rare)]
    rows += [(6000 + n, f"{copied} common{n}") for n in range(400)]  # near copies: the terms are above the band anyway
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["near_edited"], r["near_next"]) for r in imatch.compared_with_next(docs).collect()}
    assert len(got) == len(rows) and min(got[i][0] for i in [*range(2000, 2499), 5000]) > 0.05
    assert all(got[i][0] > got[i][1] for i in (2000, 5000))  # the next text is another one
    twice = docs.where("doc_id < 1000").unionByName(docs.where("doc_id = 7").crossJoin(spark.range(300)).select("doc_id", "text"))
    assert imatch.lexicon(twice) == imatch.lexicon(docs.where("doc_id < 1000"))


def plain_print(text, band, lexicon, above):
    """A fingerprint, subset by subset and word by word."""
    words = {w.strip(b".,;:!?\"'()[]") for w in text.encode().lower().split()} - {b""}
    if not words:
        return "-" * 8 * band.size + xxhash.xxh128_hexdigest(text.encode())
    hashed = lambda w: xxhash.xxh64_intdigest(w, band.seed)
    known = words & set(lexicon)
    missing = min(imatch.MOST, max(imatch.FEWEST, len(words) // 2) - len(known))
    if missing > 0:
        known |= set(sorted(words & set(above), key=above.index)[:missing])
        known |= set(sorted(words - set(lexicon) - set(above), key=lambda w: (hashed(w), w))[:missing])
    out = ""
    for share in band.parts:
        for number in range(band.subsets):
            key, inside = xxhash.xxh64_intdigest(f"{band.seed}/{share}"), []
            for word in known:
                draw = (hashed(word) ^ key) * 0x9E3779B97F4A7C15 % 2**64
                draw = (draw ^ draw >> 29) * 0xC2B2AE3D27D4EB4F % 2**64
                draw = (draw - number * (2**64 // band.subsets)) % 2**64
                if draw >> 32 < int(share * 2**32):
                    inside.append(hashed(word))
            data = b"".join(h.to_bytes(8, "little") for h in sorted(inside))
            out += f"{min(len(inside), 15):x}" + xxhash.xxh32_hexdigest(data)[1:] if inside else "-" * 8
    return out


def test_query_equals_plain_prints(spark):
    """Lexicon, prints and edited prints of the whole table, recomputed term by term."""
    band = imatch.Band()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    distinct, counts = set(docs.values()), Counter()
    for text in distinct:
        counts.update({w.strip(b".,;:!?\"'()[]") for w in text.encode().lower().split()} - {b""})
    lexicon = [w for w, n in counts.items() if band.low * len(distinct) < n <= band.high * len(distinct)]
    above = [w for n, w in sorted((n, w) for w, n in counts.items() if n > band.high * len(distinct))]
    order = sorted(docs, reverse=True)
    got = {r["doc_id"]: r for r in QUERIES["op2_imatch_prints"](spark, SF).collect()}
    for at, doc_id in enumerate(order[:120]):
        text, following = docs[doc_id], docs[order[(at + 1) % len(order)]]
        assert got[doc_id]["fingerprint"] == plain_print(text, band, lexicon, above)
        if at % 4 == 0:
            assert got[doc_id]["edited_fingerprint"] == plain_print(text[:len(text) - len(text) // 3] + following[:len(text) // 3], band, lexicon, above)
