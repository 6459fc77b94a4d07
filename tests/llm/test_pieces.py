"""Op11 against the library, text by text."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from dossier.llm import pieces as P

LIB = SentencePieceProcessor(model_file=P.MODEL)
M = P.model(P.MODEL)
ODD = ["", " ", "  ", "   a  b ", "▁x ▁", "a\x00b", "\t\n\r", "é漢😀", "<s></s><unk><0x0A>", "﻿a​",
       " " * 1000, "a" * 3000, "ab" * 2000, "的" * 500, "\U0001F468‍\U0001F469", "x" + " " * 37 + "y", "￿", "é"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    ids = LIB.encode(text)
    assert M.ids_of(text) == ids and M.decode(ids) == LIB.decode(ids)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aabbcdeeinrst \n▁.,<>0"), st.characters(codec="utf-8")), max_size=80))
def test_any_text(text):
    ids = LIB.encode(text)
    assert M.ids_of(text) == ids and M.decode(ids) == LIB.decode(ids)


def test_backtracking_without_segments():
    """Pieces glued at random make the longest match fail often."""
    rng = random.Random(5)
    every = sorted(M.ids)
    for _ in range(3000):
        text = "".join(rng.choices(every, k=rng.randrange(1, 8)))
        assert [LIB.id_to_piece(i) for i in M.ids_of(text)] == LIB.encode_as_pieces(text)


def test_each_pair_decides():
    """``cut`` equals merging by its definition, on short texts."""
    rng = random.Random(6)
    every = [p for p in sorted(M.ids) if len(p) > 2]
    for _ in range(500):
        text = "".join(p[rng.randrange(len(p)):] for p in rng.choices(every, k=4))
        assert M.cut(text) == M.merged(text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(i, text):
    ids = LIB.encode(text or "")
    return i, len(ids), sha(",".join(map(str, ids))), sha(LIB.decode(ids) if ids else "")


def test_digests_and_encoded(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "x y"), (99, None), (0, ""), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(t, i, "k", 1) for i, t in rows], "TEXT2 string, doc_id long, ids string, n_tokens int")
    got = P.digests(docs, text_col="TEXT2")
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    key = repr
    assert sorted(map(tuple, got.collect()), key=key) == sorted((want(i, t) for i, t in rows), key=key)
    full = P.encoded(docs, text_col="TEXT2")
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in full.collect()), key=key) == sorted(
        ((i, LIB.encode(t or ""), LIB.decode(LIB.encode(t or "")) if t else "") for i, t in rows), key=key)
    assert P.digests(docs.limit(0), text_col="TEXT2").collect() == []


def test_query_over_documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = P.op11_sentencepiece(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(want(r.doc_id, r.text) for r in rows)
