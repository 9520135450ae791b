"""Columns of the user with the names that operators use inside, and an entry without the libraries of this part."""

import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from lakesync.llm import lines, substrings
from lakesync.llm.shared import Scratch
from tests.conftest import SF

INSIDE = ["_gone", "_lines", "_at", "_maybe", "_row", "_spot", "_word", "_bits", "_score", "_doc", "n_removed", "n_words", "n_lines", "root", "node",
          "first", "row", "line", "key", "fp", "component_id", "said", "x", "label", "_place", "_chars", "a b", "doc.id"]


@pytest.mark.parametrize("names", [INSIDE[:14], INSIDE[14:]], ids=["marks", "words"])
def test_stages_keep_columns_of_any_name(spark, names):
    passage = " ".join(f"word{n}" for n in range(40))
    rows = [(n, f"{passage}\nown line number {n} of this text\n{passage}" if n % 2 else f"short text {n}", *[100 * n + k for k in range(len(names))]) for n in range(8)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'`{name}` long' for name in names)}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = Scratch(spark).cut(stage(spark, docs, SF))
        assert out.columns == docs.columns
        assert {tuple(r)[2:] for r in out.collect()} <= {row[2:] for row in rows} and out.count() > 0
        if name in ("lines", "substrings"):
            assert {tuple(r)[2:] for r in out.collect()} == {row[2:] for row in rows}
            assert out.where("text LIKE '%word0 word1%'").count() == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == set(range(8))


def test_operators_keep_columns_of_other_names(spark):
    names = [name for name in INSIDE if name not in ("n_removed", "n_words", "n_lines", "a b", "doc.id")]
    docs = spark.createDataFrame([(1, "a line\nb line", *range(len(names)))], f"doc_id long, text string, {', '.join(f'`{name}` int' for name in names)}")
    for row in (lines.dedup(docs).first(), substrings.dedup(docs).first()):
        assert [row[name] for name in names] == list(range(len(names)))


@pytest.mark.parametrize("missing", ["ahocorasick", "xxhash", "tokenizers", "public_tokenizers"])
def test_entry_without_a_library(missing):
    code = f"""
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] == {missing!r}:
            raise ModuleNotFoundError(f'No module named {{name!r}}', name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
names = set(entry.queries())
assert 'merge_upsert' in names and not any(n.startswith('op') and n[2].isdigit() for n in names), names
assert set(entry.oracle_sql()) <= names
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
