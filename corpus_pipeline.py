"""From raw documents to packed training sequences: five of the text operators in a row.

Each stage works on everything the one before kept; its result is written to the shared folder and read again. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.llm import bpe, lines, packing, quality, simhash, substrings
from lakesync.llm.shared import Scratch, marked, packed, unpacked
from lakesync.session import configure

#: Documents with a lower quality score are rejected.
LEAST_QUALITY = 0.3
#: Bytes of a record batch between Spark and Python. Executors hold several at a time on both sides, next to all that
#: earlier stages left in the process; Spark's own bound is 64 MB or 10,000 texts.
BATCH_BYTES = 2 << 20


def _cleaned(docs: DataFrame, clean: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The documents with the texts ``clean`` leaves, ``n_chars`` counted anew where one lost something.

    The other columns go along in a struct, so that their names meet none of the operators'.
    """
    cleaned = clean(packed(docs, "doc_id", "text"))
    values = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("_doc").getField("n_chars"))
    return cleaned.select(*unpacked(docs.columns, **values))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality model does not reject; the model learns from the labels it may learn from."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = packed(docs, "text").withColumn("_score", quality.score(model, "text"))
    return rows.where(F.col("_score") >= LEAST_QUALITY).select(*unpacked(docs.columns, text=F.col("text")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without lines that are alike to an earlier one of the corpus; one left without text stays as an empty document."""
    return _cleaned(docs, lines.dedup)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id, of equal ids the first row (null ids last)."""
    scratch = Scratch(spark)
    rows = packed(docs, "doc_id", "text").withColumn("_row", F.monotonically_increasing_id())
    found = scratch.cut(simhash.near_groups(rows, shingle=3, radius=2, keep=("doc_id", "_row"), scratch=scratch).select("doc_id", "_row", "root"))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_row")
    firsts = found.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = scratch.cut(found.join(firsts, "root").where(F.col("first._row") != F.col("_row")).select("_row"))
    rows = marked(rows, "_row", gone)
    kept = rows.where("_maybe").join(gone, "_row", "left_anti").select("doc_id", "text", "_doc")
    kept = kept.unionByName(rows.where("NOT _maybe").select("doc_id", "text", "_doc"))
    return kept.select(*unpacked(docs.columns, doc_id=F.col("doc_id"), text=F.col("text")))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without the words of passages that a document with a smaller id has."""
    return _cleaned(docs, substrings.dedup)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, bpe.read_spec(public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage), ("lines", line_stage), ("simhash", simhash_stage), ("substrings", substring_stage), ("packing", packing_stage)]

#: Models, signatures and automata are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(configure(spark))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.cut(docs)
    return docs
