"""The pipeline's stages against brute force, each on what the one before kept."""

import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from lakesync.llm import quality
from lakesync.llm.queries import QUERIES
from lakesync.llm.shared import Scratch
from tests.conftest import SF
from tests.llm.brute import check_pieces, lines_removed, passages_removed
from tests.llm.test_bpe import ids_of
from tests.llm.test_simhash import grouped, plain


def texts(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def test_stages_match_brute_force(spark):
    stages, scratch = dict(corpus_pipeline.STAGES), Scratch(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns

    def run(name, docs):
        return scratch.cut(stages[name](spark, docs, SF))

    kept = run("quality", docs)
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r[0] for r in docs.select("doc_id", quality.score(model).alias("s")).collect() if r[1] >= 0.3}
    assert {i for i, _ in texts(kept)} == want and 0.5 < len(want) / docs.count() < 1

    lined = run("lines", kept)
    rows = texts(kept)
    found, plain_found = dict(texts(lined)), {i: t for (i, _), (t, _) in zip(rows, lines_removed(rows))}
    assert set(found) == set(plain_found) and sum(found[i] != plain_found[i] for i in found) <= 0.01 * len(found)

    single = run("simhash", lined)
    groups = grouped([(i, plain(t)) for i, t in texts(lined)])
    assert sorted(i for i, _ in texts(single)) == sorted({first for *_, first in groups})

    cleaned = run("substrings", single)
    before = dict(texts(single))
    assert dict(texts(cleaned)) == {i: " ".join(words) if gone else before[i] for i, _, gone, words in passages_removed(texts(single))}
    for stage in (kept, lined, single, cleaned):
        assert stage.columns == columns and stage.where("n_chars != length(text)").count() == 0

    pieces = [r.asDict() for r in stages["packing"](spark, cleaned, SF).collect()]
    check_pieces(pieces, {i: [[*ids_of(t), 2]] for i, t in texts(cleaned)})
    whole = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in whole.collect()) == sorted((p["doc_id"], p["start"], p["ids_crc32"]) for p in pieces)


def test_hard_rows_pass_all_stages(spark):
    rows = [(1, None, None, None, None), (1, "same text here", "en", "s", 14), (1, "same text here", "en", "s", 14), (None, "", "x", None, 0), (2, "long " * 30000, None, "s", 1), (3, "a\n\nb", "de", "t", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {}
    for case, stage in (("rows", docs), ("none", docs.limit(0))):
        for name, build in corpus_pipeline.STAGES:
            before, stage = stage, Scratch(spark).cut(build(spark, stage, SF))
            kept[case, name] = stage.count()
            if name != "packing":
                assert stage.columns == docs.columns and {tuple(r)[2:4] for r in stage.collect()} <= {r[2:4] for r in rows}
            if name == "lines":  # no document goes, of the two equal ones the later is empty now
                assert kept[case, name] == before.count() and {len(r["text"] or "") for r in stage.where("source = 's' AND lang = 'en'").collect()} <= {0, 14}
            if name == "packing":  # each document that is left ends in one token of its own
                ends = stage.where("start + length = doc_tokens")
                assert ends.count() == before.count() and {r["doc_id"] for r in ends.collect()} == {r["doc_id"] for r in before.collect()}
    assert kept["rows", "simhash"] >= 1 and not any(n for (case, _), n in kept.items() if case == "none")


def test_every_operator_is_registered():
    names = list(driver.queries())
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 14)) and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "simhash", "substrings", "packing"]
    assert set(QUERIES) <= set(names)


def test_batches_handed_to_python_are_bounded_in_bytes(spark, tmp_path, monkeypatch):
    """Ten thousand texts a batch, on both sides of each worker, were more than an executor had left in later stages."""
    spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 600).alias("text")).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([part.nbytes])], ["n"])

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", lambda spark, docs, folder: docs.mapInArrow(sizes, "n long"))])
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        found = [r["n"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert sum(found) > 12e6 and max(found) < 3e6
