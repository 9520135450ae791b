"""Quality rules by host: failures per host, shrunk with an empirical beta prior, decide about all its documents.

Native: only built-in functions, no Python on executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.shared import Scratch, once, text_of, words_of

WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """A document fails on its own below ``words`` words or above ``repeated_pct`` % repeated words; a host whose shrunk
    failure rate is above ``host_rate`` loses all its documents."""

    words: int = 20
    repeated_pct: int = 30
    host_rate: float = 0.5


def measures(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts per document: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` next to the kept columns.

    Null and empty texts count zero everywhere. Windows of words are compared by a 64-bit hash, within a document only.
    """
    rows = docs.select(*keep, text_of().alias("_text"))
    rows = once(rows, _words=words_of(F.col("_text")))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.transform("_words", lambda word: F.xxhash64(word))
    rows = once(rows.withColumn("_size", F.size("_words")), _hashes=hashes, _lines=lines,
                _chars=F.length(F.array_join("_words", "")).cast("long"),
                _symbols=F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long"))
    many = F.col("_size") >= WINDOW
    windows = F.when(many, F.transform(F.sequence(F.lit(1), F.greatest(F.col("_size") - (WINDOW - 1), F.lit(1))),
                                       lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW))))
    rows = once(rows.drop("_text", "_words"), _windows=windows)
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = once(rows.drop("_hashes"), _placed=placed)
    last = F.size("_placed") - 1
    twin = lambda x, i, j: F.get("_placed", j)["h"].eqNullSafe(x["h"])
    found = F.filter(F.transform("_placed", lambda x, i: F.when(
        ((i > 0) & twin(x, i, i - 1)) | ((i < last) & twin(x, i, i + 1)), x["i"])), lambda i: i.isNotNull())
    rows = once(rows.drop("_windows"), _found=F.sort_array(found))
    # A repeated window adds the words up to the next repeated window, at most its own.
    covered = F.aggregate(F.zip_with("_found", F.slice("_found", 2, F.greatest(F.size("_found"), F.lit(1))),
                                     lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
                          F.lit(0).cast("long"), lambda total, step: total + step)
    return rows.select(*keep, F.col("_size").cast("long").alias("n_words"), F.col("_chars").alias("word_chars"),
                       F.col("_symbols").alias("n_symbols"),
                       (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                       F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def with_base(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Add ``base_failed``: too few words, or too many of them in repeated windows."""
    failed = (F.col("n_words") < limits.words) | (100 * F.col("n_repeat_words") > limits.repeated_pct * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def host_rates(judged: DataFrame, host: str = "host") -> DataFrame:
    """Per host: documents, failures and the failure rate shrunk toward the mean of all hosts.

    The beta prior comes from the hosts' own rates by moments: their spread beyond what their sizes explain sets its
    weight, so a host with few documents stays near the mean. No spread (or one host) means an infinitely heavy prior,
    which is capped at the number of all documents.
    """
    hosts = judged.groupBy(host).agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.count("*").alias("hosts"),
                      F.avg(F.col("failed") / F.col("n")).alias("rate"), F.var_pop(F.col("failed") / F.col("n")).alias("spread"),
                      F.avg(1 / F.col("n")).alias("noise")).first()
    if not total["n"]:
        return hosts.withColumn("rate", F.lit(0.0))
    mean = total["failed"] / total["n"]
    spread = total["spread"] + (total["rate"] - mean) ** 2 - mean * (1 - mean) * total["noise"]
    weight = float(total["n"]) if spread <= 0 else min(float(total["n"]), max(0.0, mean * (1 - mean) / spread - 1))
    return hosts.withColumn("rate", (F.col("failed") + weight * mean) / (F.col("n") + weight))


def judge(docs: DataFrame, host: str = "source", limits: Limits = Limits(), scratch: Scratch | None = None) -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``host_rate`` and ``kept`` for each document.

    A null host is a host of its own. Texts are read once: the narrow measures are written to the shared folder, hosts
    are summed from there, and verdicts join back to them, so a host with a third of all rows is summed per task first
    and its rows are split by Spark's skew handling (or not moved at all, with few hosts).
    """
    scratch = scratch or Scratch(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.col(host).alias("host"))
    judged = scratch.cut(with_base(measures(rows, ("doc_id", "host")), limits))
    rates = host_rates(judged).select(F.col("host").alias("_host"), F.col("rate").alias("host_rate"))
    joined = judged.join(rates, judged["host"].eqNullSafe(rates["_host"]), "left").drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= limits.host_rate))
