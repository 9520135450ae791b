"""Language network and quality model: gradients, held-out accuracy, edge cases."""

import math
from bisect import bisect_right
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lakesync.llm import language, quality
from lakesync.llm.queries import QUERIES
from tests.conftest import SF


def test_gradients_match_differences():
    net = language.Network.fresh(["a", "b", "c"], hidden=3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    words, labels, weight = [b"ab", b"cdefg", b"x"], np.array([0, 2, 1]), np.array([1.0, 2.0, 0.5])
    _, grads = language._gradients(net, words, labels, weight)
    rng = np.random.default_rng(0)
    for name, value in net.weights.items():
        spots = [np.unravel_index(i, value.shape) for i in rng.integers(0, value.size, 6)]
        spots += [(b"cdefg"[0], 1)] if name.startswith("in") else []
        for spot in spots:
            old, losses = value[spot], []
            for step in (1e-3, -1e-3):
                value[spot] = old + step
                losses.append(language._gradients(net, words, labels, weight)[0])
            value[spot] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - grads[name][spot]) < 2e-4


def test_padding_does_not_change_a_word():
    net = language.Network.fresh(["a", "b"])
    alone, _ = language.position_probabilities(net, [b"abc"])
    padded, mask = language.position_probabilities(net, [b"abc", b"abcdefgh"])
    assert np.allclose(alone[:, 0], padded[:3, 0], atol=1e-6) and mask[:, 0].sum() == 3


def test_language_of_held_out_documents(spark):
    got = QUERIES["op5_language_network"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 30 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert got.where("score < 0 OR score > 1").count() == 0


def test_language_edge_cases(spark):
    rows = [(1, "abc abd", "x"), (2, "zzy zyz", "y"), (3, None, None), (4, "", "x"), (5, "123 !? 456", "y"), (6, "漢字", None), (None, "abc abc", "x"), (7, "zyz " * 40000, None), (8, "z" * 500, None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    net = language.train(docs, words=100)
    got = {(r["doc_id"]): (r["lang_pred"], r["score"]) for r in docs.select("doc_id", language.identify(net).alias("f")).select("doc_id", "f.*").collect()}
    assert got[3] == got[4] == got[5] == ("und", 0.0) and {got[i][0] for i in (1, 2, 6, 7, 8, None)} <= {"x", "y"}
    none = language.train(docs.where("lang IS NULL"))
    assert [r["l"] for r in docs.limit(1).select(language.identify(none)["lang_pred"].alias("l")).collect()] == ["und"]
    assert docs.limit(0).select(language.identify(net)).count() == 0


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op9_quality_model"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 40 and sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)
    bad, good = ([r["score"] for r in rows if r["quality"] == q] for q in (0, 1))
    assert np.mean([b < g for b in bad for g in good]) > 0.98


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(n, "good words here and there " * n, 1) for n in range(12)] + [(None, None, 1), (50, "", 1), (51, "x" * 90000, 1)], "doc_id long, text string, label int")
    blank = spark.createDataFrame([], "doc_id long, quality int")
    only = spark.createDataFrame([(n, 1) for n in range(12)] + [(None, 0), (3, None)], "doc_id long, quality int")
    for labels, want in ((blank, 0.5), (only, None)):
        model = quality.train(docs, labels)
        scores = {r["s"] for r in docs.select(quality.score(model).alias("s")).collect()}
        assert len(scores) == 1 and (want is None or abs(scores.pop() - want) < 1e-9)
    assert docs.limit(0).select(quality.score(model)).count() == 0
    assert len(quality.features(b"one two\none two")) == len(quality.FEATURES) == len(quality.features(b""))


def test_held_out_labels_are_not_learned(spark):
    docs = spark.createDataFrame([(n, f"word{n} " * (1 + n % 7)) for n in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 7 > 3).cast("int").alias("quality"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    probe = np.random.default_rng(0).normal(size=(50, len(quality.FEATURES)))
    assert (quality.train(docs, labels).score(probe) == quality.train(docs, turned).score(probe)).all()


def test_every_language_is_learned(spark):
    """More than 64 values of lang, and one with most words of all."""
    rows = [(n, f"{chr(0x4E00 + 40 * (n % 70))}{chr(0x4E05 + 40 * (n % 70))} " * 3, f"l{n % 70:02}") for n in range(700)]
    rows += [(1000 + n, " ".join(f"word{n}x{k}" for k in range(500)), "big") for n in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language.train(docs, words=200)
    assert net.languages == sorted({row[2] for row in rows})


def plain_chances(net, word):
    """Distribution for each byte of a word, one scalar gate after the other."""
    w = {name: value.astype(float) for name, value in net.weights.items()}
    hidden, states = w["rec0"].shape[0], {}
    sig = lambda v: 1 / (1 + math.exp(-v))
    for way in "01":
        state, states[way] = [0.0] * hidden, {}
        for at in range(len(word)) if way == "0" else reversed(range(len(word))):
            given = w["in" + way][word[at]] + w["b" + way]
            back = np.array(state) @ w["rec" + way] + w["rb" + way]
            state = [(lambda reset, update: (lambda fresh: (1 - update) * fresh + update * state[h])(math.tanh(given[2 * hidden + h] + reset * back[2 * hidden + h])))(
                sig(given[h] + back[h]), sig(given[hidden + h] + back[hidden + h])) for h in range(hidden)]
            states[way][at] = state
    out = []
    for at in range(len(word)):
        scores = np.array(states["0"][at] + states["1"][at]) @ w["out"] + w["out_b"]
        out.append([math.exp(v - max(scores)) for v in scores])
        out[-1] = [v / sum(out[-1]) for v in out[-1]]
    return out


def test_language_query_equals_position_by_position(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net, known = language.train(docs), {}
    got = {r["doc_id"]: r for r in QUERIES["op5_language_network"](spark, SF).collect()}
    checked = 0
    for doc_id, text in docs.select("doc_id", "text").collect():
        pieces = [word[a:a + 48] for word in (text or "").encode().split() for a in range(0, len(word), 48)]
        if doc_id % 4 and len(set(pieces)) > 30:  # the others, and all short ones
            continue
        for piece in pieces:
            if piece not in known:
                known[piece] = np.sum(plain_chances(net, piece), axis=0)
        total = np.sum([known[piece] for piece in pieces], axis=0) if pieces else None
        if total is None or not any(map(str.isalpha, text)):
            want = ("und", 0.0)
        else:
            want = (net.languages[int(np.argmax(total))], max(total) / total.sum())
        assert got[doc_id]["lang_pred"] == want[0] and abs(got[doc_id]["score"] - want[1]) < 1e-4
        checked += 1
    assert checked >= 50


def plain_features(text):
    """The features from words, lines and characters, one after the other."""
    words, lines = text.encode().split(), [line for line in text.encode().split(b"\n") if line.split()]
    if not words:
        return [0.0] * 15
    data, n = text.encode(), len(words)
    upper, lower = sum(65 <= b <= 90 for b in data), sum(97 <= b <= 122 for b in data)
    digits, shouts, beyond = sum(48 <= b <= 57 for b in data), sum(b in b"!?" for b in data), sum(b >= 128 for b in data)
    marks = sum(b > 32 for b in data) - upper - lower - digits - shouts - beyond
    counts = Counter(words)
    pairs = {(words[i], words[i + 1]) for i in range(n - 1)}
    return [math.log(1 + n), sum(len(w) for w in words) / n, upper / max(1, upper + lower), digits / len(data), shouts / len(data), marks / len(data),
            beyond / len(data), len(counts) / n, len(pairs) / (n - 1) if n > 1 else 1.0, 1 - len(set(lines)) / len(lines), math.log(1 + len(lines)),
            n / len(lines), sum(len(w) <= 3 for w in words) / n, math.log(1 + max(len(w) for w in words)), max(counts.values()) / n]


def test_quality_query_equals_bin_by_bin(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in QUERIES["op9_quality_model"](spark, SF).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        x = plain_features(text or "")
        logit = model.intercept + sum(table[bisect_right(list(edges), v)] for table, edges, v in zip(model.tables, model.edges, x))
        for j, k, table in model.pairs:
            logit += table[bisect_right(list(model.coarse[j]), x[j])][bisect_right(list(model.coarse[k]), x[k])]
        want = 1 / (1 + math.exp(-logit))
        assert abs(got[doc_id][0] - want) < 1e-9 and got[doc_id][1] == (want >= 0.3)
    assert len(model.pairs) == 5 and len(got) == docs.count()


def test_one_id_on_many_rows_stays_within_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels, **_: seen.append((len(rows), labels.tolist())))
    copies = spark.createDataFrame([(1, "one text " * 5)] * 300 + [(1, f"text {n} of many") for n in range(300)] + [(2, "other"), (2, "other")], "doc_id long, text string")
    for labels, sample, want in (([(1, 1)], 10, 10), ([(2, 0), (2, 0)], 10, 1), ([(1, 1), (1, 0), (2, 1)], 1000, 603)):
        quality.train(copies, spark.createDataFrame(labels, "doc_id long, quality int"), sample=sample)
        assert seen[-1][0] == want


def test_runs_without_blanks_are_learned_whole(spark):
    """Two languages that begin alike and go on in letters of their own, in one run without blanks."""
    rng = np.random.default_rng(1)
    same = "".join(chr(0x4E00 + k) for k in rng.integers(0, 50, 16))
    rows = [(n, same + "".join(chr((0x5E00, 0x6E00)[n % 2] + k) for k in rng.integers(0, 60, 60)), "xy"[n % 2]) for n in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language.train(docs)
    held = docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 == 1).select("lang", language.identify(net)["lang_pred"].alias("p")).collect()
    assert len(held) > 150 and sum(r["lang"] == r["p"] for r in held) >= 0.95 * len(held)


def test_many_languages_stay_within_the_bound(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "fit", lambda words, labels, weight, names: seen.append((Counter(labels.tolist()), names)))
    monkeypatch.setattr(language, "MOST_WORDS", 100_000)
    docs = spark.range(60_000).select("id", F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), "id") for k in range(8)]).alias("text"), F.concat(F.lit("l"), F.col("id") % 5000).alias("lang"))
    language.train(docs.withColumnRenamed("id", "doc_id"))
    counts, names = seen[0]
    assert len(names) == 5000 and min(counts.values()) >= 10  # about FEWEST_WORDS, dealt by hash over slices
    assert max(counts.values()) <= 100_000 // 5000 + 2 * language.SLICES
