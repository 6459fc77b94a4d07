"""Op2: ids against the tokenizer itself, packing invariants and waste."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dossier.llm import packing as P

WHOLE = P.Encoder(P.TOKENIZER).whole
ODD = ["", " ", "\n\t\x0b\r\x0c", "It's 12½ m² THE. <|endoftext|> a<|startoftext|>b", "été ẞ İi ΣΑΣ",
       "a b c \x1c d\u0085e", "%%% a*** !!", "你好 123 ٤", "x" * 5000]


def ids(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_library(text):
    assert np.frombuffer(P.Encoder(P.TOKENIZER).encode(text), "<u4").tolist() == ids(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aZ'sé!1 \n\xa0́<|>", max_size=40))
def test_ids_equal_the_library_on_any_text(text):
    assert np.frombuffer(P.encoder(P.TOKENIZER).encode(text), "<u4").tolist() == ids(text)


def test_corpus_ids(spark, sf):
    enc = P.encoder(P.TOKENIZER)
    for (t,) in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect():
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == ids(t)


def spec(lengths, capacity):
    """The rule as it reads, one bin at a time."""
    gaps, out = [], []
    for s in lengths:
        def total(after):
            return sum(after.count(g) ** 2 for g in set(after) if g)
        options = [(total(gaps[:i] + [g - s] + gaps[i + 1:]), g) for i, g in enumerate(gaps) if g >= s]
        fresh = total(gaps + [capacity - s])
        if options and min(options)[0] <= fresh:
            i = gaps.index(min(options)[1])
            gaps[i] -= s
        else:
            gaps.append(capacity - s)
        out.append(tuple(sorted(gaps)))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 11), max_size=25))
def test_rule(lengths):
    bins, offsets, gaps = P.sum_of_squares(np.array(lengths, np.int64), 12)
    ends = {}
    for b, o, s in zip(bins, offsets, lengths):
        assert ends.get(b, 0) == o  # gapless from 0
        ends[b] = o + s
    assert all(12 - ends[b] == g >= 0 for b, g in zip(bins, gaps))
    want = spec(lengths, 12)
    assert tuple(sorted(12 - e for e in ends.values())) == (want[-1] if want else ())


def check_layout(rows, capacity):
    at = {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end = o + n
        assert end <= capacity
    return len(at)


def test_corpus_packing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = P.pack(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == text.keys()
    for d, parts in by.items():
        parts.sort(key=lambda r: r.piece)
        full = ids(text[d]) + [1]
        assert [r.start for r in parts] == list(range(0, len(full), 4096))
        for r in parts:
            cut = full[r.start:r.start + 4096]
            assert r.length == len(cut) and r.ids_crc32 == zlib.crc32(np.array(cut, "<u4").tobytes())
    n = check_layout(rows, 4096)
    assert n <= 1.05 * sum(r.length for r in rows) / 4096 + 1


def test_many_shards_waste_as_little_as_one(spark):
    rng = np.random.default_rng(7)
    lengths = [int(x) for x in np.minimum(100, rng.geometric(0.04, 3000))]
    cut = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long")
    out = P.place(P.stage(cut, "t"), capacity=100, per_shard=200, closed=2).collect()
    assert sorted((r.id, r.length) for r in out) == list(enumerate(lengths))
    assert check_layout(out, 100) <= 1.02 * sum(lengths) / 100 + 1


def test_pieces_that_never_fit_end(spark):
    cut = spark.createDataFrame([(i, 60) for i in range(900)], "id long, length long")
    out = P.place(P.stage(cut, "t"), capacity=100, per_shard=100, closed=2).collect()
    assert check_layout(out, 100) == 900


def test_edges(spark):
    schema = "doc_id long, text string, offset int, ids string, sequence_id string, gap int"
    rows = [(None, "a b", 1, "", "", 1), (1, None, 1, "", "", 1), (1, "", 1, "", "", 1), (2, "a b", 1, "", "", 1),
            (2, "a b", 1, "", "", 1), (3, "a " * 5000, 1, "", "", 1)]
    out = P.pack(spark.createDataFrame(rows, schema), with_ids=True)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    got = out.collect()
    assert sorted((r.doc_id or 0, r.piece, r.length) for r in got) == [
        (0, 0, 3), (1, 0, 1), (1, 0, 1), (2, 0, 3), (2, 0, 3), (3, 0, 4096), (3, 1, 905)]
    check_layout(got, 4096)
    seqs = {r.sequence_id: r.ids for r in P.sequences(out).collect()}
    assert sum(len(x) for x in seqs.values()) == 4 * sum(r.length for r in got)
    for r in P.pack(spark.createDataFrame(rows, schema), with_ids=True).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32
    assert P.pack(spark.createDataFrame([], schema)).collect() == []
