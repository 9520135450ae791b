"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads each word (the run of bytes between blanks) in both directions and gives every byte a distribution
over languages; a document's distribution is the mean over all its bytes. State starts anew at each word, so the bytes
of a word are labelled alike wherever it stands, and a task runs the network once per distinct word it holds.
Trained in numpy by backpropagation through time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lakesync.llm.shared import text_of, utf8, words_of

UNKNOWN = "und"
#: Longer words are read in pieces of this many bytes.
LONGEST = 48
#: Distinct words whose results a task keeps; then it starts anew.
KEPT_WORDS = 300_000
#: Distinct words learned of each language at least, and the slices they are ranked in.
LEAST_WORDS, SLICES = 512, 16
#: Pieces of words for all languages together before each gets less than that, and what each gets in any case.
MOST_WORDS, FEWEST_WORDS = 400_000, 16


@dataclass
class Network:
    """Weights by direction (0 forward, 1 backward): input table (256 x 3H), recurrence (H x 3H), biases; and the output."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = 16, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        weights = {"out": rng.normal(0, 0.3, (2 * hidden, len(languages))), "out_b": np.zeros(len(languages))}
        for way in "01":
            weights |= {"in" + way: rng.normal(0, 0.3, (256, 3 * hidden)), "rec" + way: rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)),
                        "b" + way: np.zeros(3 * hidden), "rb" + way: np.zeros(3 * hidden)}
        return cls(languages, {name: value.astype(np.float32) for name, value in weights.items()})


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as (time, word), zero behind the end, and the mask of real bytes."""
    lengths = np.array([len(word) for word in words])
    steps = int(lengths.max(initial=1))
    data = np.frombuffer(b"".join(word.ljust(steps, b"\0") for word in words), np.uint8).reshape(len(words), steps).T
    return data, np.arange(steps)[:, None] < lengths[None, :]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(weights: dict, way: str, data: np.ndarray, mask: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (time, word, H) of one direction; a padded step keeps the state. ``trace`` collects what learning needs."""
    steps, size = data.shape
    hidden = weights["rec" + way].shape[0]
    state = np.zeros((size, hidden), np.float32)
    states = np.empty((steps, size, hidden), np.float32)
    for t in range(steps) if way == "0" else range(steps - 1, -1, -1):
        given = weights["in" + way][data[t]] + weights["b" + way]
        back = state @ weights["rec" + way] + weights["rb" + way]
        gates = _sigmoid(given[:, :2 * hidden] + back[:, :2 * hidden])
        reset, update = gates[:, :hidden], gates[:, hidden:]
        fresh = np.tanh(given[:, 2 * hidden:] + reset * back[:, 2 * hidden:])
        before = state
        state = np.where(mask[t][:, None], fresh + update * (before - fresh), before)
        states[t] = state
        if trace is not None:
            trace.append((t, before, reset, update, fresh, back[:, 2 * hidden:]))
    return states


def position_probabilities(net: Network, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distribution over languages for every byte (time, word, language), and the mask of real bytes."""
    data, mask = padded(words)
    both = np.concatenate([_run(net.weights, way, data, mask) for way in "01"], axis=2)
    scores = both @ net.weights["out"] + net.weights["out_b"]
    scores = np.exp(scores - scores.max(axis=2, keepdims=True))
    return scores / scores.sum(axis=2, keepdims=True), mask


def _gradients(net: Network, words: list[bytes], labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
    w = net.weights
    data, mask = padded(words)
    traces = {way: [] for way in "01"}
    both = np.concatenate([_run(w, way, data, mask, traces[way]) for way in "01"], axis=2)
    scores = both @ w["out"] + w["out_b"]
    scores = np.exp(scores - scores.max(axis=2, keepdims=True))
    chance = scores / scores.sum(axis=2, keepdims=True)
    share = (mask * weight / max(1e-9, (mask * weight).sum())).astype(np.float32)[:, :, None]
    columns = np.arange(len(words))
    loss = -float((np.log(chance[:, columns, labels] + 1e-9) * share[:, :, 0]).sum())
    error = chance
    error[:, columns, labels] -= 1
    error *= share
    hidden = w["rec0"].shape[0]
    grads = {name: np.zeros_like(value) for name, value in w.items()}
    grads["out"] = both.reshape(-1, 2 * hidden).T @ error.reshape(-1, error.shape[2])
    grads["out_b"] = error.sum(axis=(0, 1))
    down = error @ w["out"].T
    for number, way in enumerate("01"):
        carry = np.zeros((len(words), hidden), np.float32)
        for t, before, reset, update, fresh, back in reversed(traces[way]):
            total = carry + down[t, :, number * hidden:(number + 1) * hidden]
            real = total * mask[t][:, None]
            d_fresh = real * (1 - update) * (1 - fresh * fresh)
            d_update = real * (before - fresh) * update * (1 - update)
            d_reset = d_fresh * back * reset * (1 - reset)
            d_given = np.concatenate([d_reset, d_update, d_fresh], axis=1)
            d_back = np.concatenate([d_reset, d_update, d_fresh * reset], axis=1)
            np.add.at(grads["in" + way], data[t], d_given)
            grads["b" + way] += d_given.sum(axis=0)
            grads["rb" + way] += d_back.sum(axis=0)
            grads["rec" + way] += before.T @ d_back
            carry = np.where(mask[t][:, None], real * update, total) + d_back @ w["rec" + way].T
    return loss, grads


def fit(words: list[bytes], labels: np.ndarray, weight: np.ndarray, languages: list[str], epochs: int = 3, size: int = 256,
        rate: float = 0.01, seed: int = 7) -> Network:
    """Adam over shuffled batches of words; ``labels`` index ``languages``."""
    net, rng = Network.fresh(languages, seed=seed), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.weights.items()} for _ in range(2))
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(len(words))
        order = order[np.argsort(np.array([len(words[i]) for i in order]) // 4, kind="stable")]  # little padding
        for start in rng.permutation(range(0, len(words), size)):
            chosen = order[start:start + size]
            _, grads = _gradients(net, [words[i] for i in chosen], labels[chosen], weight[chosen])
            steps += 1
            for name, grad in grads.items():
                first[name] += 0.1 * (grad - first[name])
                second[name] += 0.001 * (grad * grad - second[name])
                net.weights[name] -= (rate * (first[name] / (1 - 0.9 ** steps)) / (np.sqrt(second[name] / (1 - 0.999 ** steps)) + 1e-8)).astype(np.float32)
    return net


def train(docs: DataFrame, per_language: int = 400, words: int = 40_000) -> Network:
    """Fit on labelled rows whose crc32(doc_id as text) mod 3 is not 1.

    Every value of ``lang`` in these rows is learned. The sample is bounded for each: about ``per_language`` documents
    (those with the smallest hash of their id), and of their distinct pieces of words (``LONGEST`` bytes of a run
    between blanks, as in prediction; all of a run) an equal share of ``words``, those with the smallest hash. With many
    languages the share is ``LEAST_WORDS``, as long as there are ``MOST_WORDS`` in all, and about ``FEWEST_WORDS`` at least:
    the driver gets about ``max(words, MOST_WORDS)`` pieces, or ``FEWEST_WORDS`` for each value of ``lang`` if that is
    more, at most. A null id counts as not held out. Without any labelled row the network has no language and everything is
    ``und``.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    known = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL").where(~held_out)
    spread = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit("sample")), F.lit(1 << 30))
    # The row with the smallest hash is taken in any case, so that no language is without a document.
    counts = known.groupBy("lang").agg(F.count("*").alias("_n"), F.min(F.when(F.length(F.trim(text_of())) > 0, spread)).alias("_least")).collect()
    if not counts:
        return Network.fresh([])
    limits = docs.sparkSession.createDataFrame([(row["lang"], max(int(min(1.0, per_language / row["_n"]) * (1 << 30)), (row["_least"] or 0) + 1)) for row in counts],
                                               "lang string, _limit long")
    chosen = known.join(F.broadcast(limits), "lang").where(spread < F.col("_limit")).select("lang", F.explode(words_of(text_of())).alias("word"))
    data = F.col("word").cast("binary")
    places = F.sequence(F.lit(0), F.floor((F.octet_length("word") - 1) / LONGEST).cast("int"))
    pieces = chosen.select("lang", F.explode(F.transform(places, lambda at: F.substring(data, at * LONGEST + 1, F.lit(LONGEST)))).alias("word"))
    pairs = pieces.groupBy("lang", "word").count()
    # Slices by hash, so that the words of a frequent language are not ranked in one task.
    most = max(words // len(counts), min(LEAST_WORDS, MOST_WORDS // len(counts)), FEWEST_WORDS)
    order = F.xxhash64("word", "lang")
    ranked = pairs.withColumn("_order", order).withColumn("_slice", F.pmod(order, F.lit(SLICES)))
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_slice").orderBy("_order", "word")))
    pairs = ranked.where(F.col("_rank") <= -(-most // SLICES))
    found = pairs.select("lang", "word", "count").orderBy("_order", "lang", "word").collect()
    names = sorted({row["lang"] for row in found})
    if not names:
        return Network.fresh([])
    # Every language weighs the same in all, a frequent word more than a rare one.
    labels = np.array([names.index(row["lang"]) for row in found])
    weight = np.log2(1 + np.array([row["count"] for row in found], dtype=float))
    weight /= np.bincount(labels, weight)[labels]
    return fit([bytes(row["word"]) for row in found], labels, weight / weight.mean(), names)


class Labeller:
    """Per distinct word the sum of its bytes' distributions, computed once and kept."""

    def __init__(self, net: Network):
        self.net, self.codes, self.sums, self.used = net, {}, np.zeros((1024, len(net.languages)), np.float32), 0
        # with more languages fewer words are kept and read at once
        self.most, self.batch = (max(64, n * 64 // max(64, len(net.languages))) for n in (KEPT_WORDS, 4096))

    def pooled(self, text: bytes) -> np.ndarray:
        """Mean distribution over all bytes of the words of a text."""
        words = text.split()
        found = list(map(self.codes.get, words))
        if None in found:
            self._learn({word for word, code in zip(words, found) if code is None})
            found = list(map(self.codes.__getitem__, words))
        total = np.bincount(found, minlength=self.used) @ self.sums[:self.used] if len(found) * 4 > self.used else self.sums[found].sum(axis=0)
        return total / max(1e-9, total.sum())

    def prepare(self, texts: list[bytes]) -> None:
        """Run the network for the new words of many texts at once."""
        if self.used > self.most:
            self.codes, self.used = {}, 0
        new = set()
        for text in texts:
            new.update(text.split())
        self._learn({word for word in new if word not in self.codes})

    def _learn(self, new: set[bytes]) -> None:
        ordered = sorted(new, key=lambda word: (len(word), word))
        if self.used + len(ordered) > len(self.sums):
            more = np.zeros((2 * (self.used + len(ordered)), self.sums.shape[1]), np.float32)
            more[:self.used] = self.sums[:self.used]
            self.sums = more
        for start in range(0, len(ordered), self.batch):
            words = ordered[start:start + self.batch]
            pieces = [(i, word[a:a + LONGEST]) for i, word in enumerate(words) for a in range(0, len(word), LONGEST)]
            sums = np.zeros((len(words), self.sums.shape[1]), np.float32)
            for at in range(0, len(pieces), self.batch):
                owners, parts = zip(*pieces[at:at + self.batch])
                chance, mask = position_probabilities(self.net, list(parts))
                np.add.at(sums, np.array(owners), (chance * mask[:, :, None]).sum(axis=0))
            self.sums[self.used:self.used + len(words)] = sums
            self.codes.update(zip(words, range(self.used, self.used + len(words))))
            self.used += len(words)


def _has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def identify(net: Network, text: Column | str = "text") -> Column:
    """Struct of ``lang_pred`` and ``score`` for a text column.

    ``und`` with score 0 for a null text or one without a letter. Ties go to the first language in sorted order.
    """

    @arrow_udf("struct<lang_pred: string, score: double>")
    def identified(texts: pa.Array) -> pa.Array:
        labeller, values, out = _labeller(net), utf8(texts), []
        for start in range(0, len(values), 256):
            part = values[start:start + 256]
            if net.languages:
                labeller.prepare(part)
            for value in part:
                if not net.languages or not _has_letter(value):
                    out.append((UNKNOWN, 0.0))
                else:
                    chance = labeller.pooled(value)
                    best = int(np.argmax(chance))
                    out.append((net.languages[best], float(min(1.0, chance[best]))))
        names, scores = zip(*out) if out else ((), ())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return identified(F.col(text) if isinstance(text, str) else text)


_LABELLERS: dict[bytes, Labeller] = {}


def _labeller(net: Network) -> Labeller:
    """One labeller per worker process and network, so that batches share what was computed."""
    key = b"".join(value.tobytes()[:256] for value in net.weights.values())
    if key not in _LABELLERS:
        _LABELLERS.clear()
        _LABELLERS[key] = Labeller(net)
    return _LABELLERS[key]
