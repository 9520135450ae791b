"""BPE against the tokenizers library."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakesync.llm import bpe
from lakesync.llm.queries import QUERIES, word_bpe
from tests.conftest import SF
from tests.llm.brute import sha

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ENCODER = bpe.WordEncoder(word_bpe())
HARD = ["", None, " \n\t\x0b\x0c\r ", "Hello, World!", "it's WE'LL don't ' '' 's", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "İstanbul ΣΑΣ ß ÿ Ÿ",
        "é ́x Å", "a b c　d\u0085e", "日本語 中文 한국어 😀👍🏽", "x1y22z 3.14 ½ ² ª", "​﻿\x00\x01", "word " * 5000, "y" * 20000, "aͅ ǅ ﬁ"]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_words_in_a_row_are_the_text(text):
    words = text.encode("utf-8", "ignore").split()
    found = np.frombuffer(b"".join(ENCODER.encode(words)), "<u4").tolist()
    assert found == ids_of(text.encode("utf-8", "ignore").decode())


def test_hard_texts_round_trip(spark):
    rows = [(i // 2 if i else None, text) for i, text in enumerate(HARD)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, kind int")
    got = sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["text"]) for r in bpe.decode(bpe.encode(docs, word_bpe()), word_bpe()).collect()), key=repr)
    want = sorted(((i, ids_of(t), LIBRARY.decode(ids_of(t), skip_special_tokens=False)) for i, t in rows), key=repr)
    assert got == want
    assert bpe.decode(bpe.encode(docs.limit(0), word_bpe()), word_bpe()).count() == 0


def test_query_matches_the_library(spark):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op1_bpe_roundtrip"](spark, SF).collect()}
    import hashlib

    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = ids_of(text)
        assert got.pop(doc_id) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(LIBRARY.decode(ids, skip_special_tokens=False)))
    assert not got


def test_missing_words_of_a_block_fail():
    with pytest.raises(RuntimeError):
        bpe._block_table([(0, np.array([1], "<u4"), np.array([5], "<u4"))], 2)
