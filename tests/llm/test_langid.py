"""Op9: phrases against a plain longest-match parse, held-out accuracy."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dossier.llm import langid as L

SCHEMA = "doc_id long, text string, lang string, h long, LANG_PRED string"


def spec(sample, text):
    """Phrases of ``text`` (a list) by longest matches in ``sample``; a letter
    that the sample lacks is a phrase of its own."""
    def inside(part):
        return any(sample[i:i + len(part)] == part for i in range(len(sample) - len(part) + 1))
    phrases, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and inside(text[at:end]):
            end += 1
        phrases += 1
        at = max(end - 1, at + 1)
    return phrases


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab c", min_size=1, max_size=25), st.lists(st.text(alphabet="abc x", min_size=1, max_size=20), max_size=4))
def test_phrases(sample, texts):
    codes = L.Folder.codes(sample)
    parser = L.Parser(codes)
    texts.sort(key=lambda t: -len(t))
    if not texts:
        return
    grid = np.full((len(texts), len(texts[0])), L.BREAK, np.uint32)
    for row, t in zip(grid, texts):
        row[:len(t)] = L.Folder.codes(t)
    got = parser.phrases(np.ascontiguousarray(parser.coded(grid).T), np.array([len(t) for t in texts]))
    for g, t in zip(got.tolist(), texts):
        assert g == spec(codes.tolist(), L.Folder.codes(t).tolist())


def test_a_script_of_thousands_of_letters():
    """5,000 letters: the parse is that of the definition, memory follows the transitions."""
    rng = np.random.default_rng(2)
    letters = np.array([c for c in range(0x4E00, 0x4E00 + 5000)], np.uint32)
    draw = (letters[np.minimum(rng.zipf(1.2, 40_000) - 1, 4999)]).astype(np.uint32)
    parser = L.Parser(draw)
    assert parser.table.nbytes + parser.keys.nbytes + parser.goes.nbytes < 30_000_000
    small = L.Parser(draw[:1500])
    texts = [np.concatenate([draw[s:s + 40], rng.choice(letters, 20), draw[s + 7:s + 30]]).astype(np.uint32) for s in range(0, 1400, 100)]
    grid = np.stack(texts)
    got = small.phrases(np.ascontiguousarray(small.coded(grid).T), np.full(len(texts), grid.shape[1]))
    assert got.tolist() == [spec(draw[:1500].tolist(), t.tolist()) for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab c", min_size=1, max_size=25), st.text(alphabet="abc x", min_size=1, max_size=20))
def test_sparse_letters_parse_alike(sample, text):
    dense, L.DENSE = L.DENSE, 1
    try:
        parser = L.Parser(L.Folder.codes(sample))
    finally:
        L.DENSE = dense
    row = L.Folder.codes(text)[None]
    got = parser.phrases(np.ascontiguousarray(parser.coded(row).T), np.array([row.shape[1]]))
    assert got.tolist() == [spec(L.Folder.codes(sample).tolist(), row[0].tolist())]


def test_blocks_and_batches(monkeypatch):
    texts = ["ab ab c" * 50, "", "...", "cab" * 7, "b"]
    models = [L.Parser(L.Folder.codes("ab abc cab b"))]
    monkeypatch.setattr(L, "BLOCK", 10)
    whole = L.entropies(texts, models)
    monkeypatch.setattr(L, "AT_ONCE", 3)
    assert np.allclose(L.entropies(texts, models), whole)
    assert whole[1, 0] == whole[2, 0] == 0 and whole[0, 0] > 0


def test_letters_fold():
    assert L.Folder.codes("aÉ1 ").tolist() == [ord("a"), ord("é"), L.BREAK, L.BREAK]


def test_corpus(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in L.op9_language_id(spark, sf).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert rows.keys() == lang.keys()
    held = [d for d in rows if rows[d].held_out]
    assert held == [d for d in rows if zlib.crc32(str(d).encode()) % 3 == 1]
    assert sum(rows[d].lang_pred == lang[d] for d in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_edges(spark):
    rows = [(i, w * 30, n, 0, "") for i, (w, n) in enumerate([("the cat and ", "en"), ("der Hund und ", "de")] * 20)]
    rows += [(90, None, "en", 0, ""), (91, "", None, 0, ""), (92, "123 ...", "de", 0, ""), (None, "der und Hund", None, 0, ""),
             (93, "the and cat " * 20_000, None, 0, ""), (93, "the and cat", None, 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = L.predicted(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == 46
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.lang_pred, round(r.score, 3), r.held_out))
    assert by[90][0][:2] == by[91][0][:2] == by[92][0][:2] == ("und", 0.0)
    assert by[None][0][0] == "de" and not by[None][0][2] and {x[0] for x in by[93]} == {"en"}
    assert all(by[i][0][0] == ("en", "de")[i % 2] for i in range(40))
    assert {r.lang_pred for r in L.predicted(docs.where("lang is null")).collect()} == {"und"}
    assert L.predicted(docs.limit(0)).collect() == []
    many = spark.createDataFrame([(i, "a", f"l{i}", 0, "") for i in range(40)], SCHEMA)
    with pytest.raises(ValueError):
        L.predicted(many)


def test_any_number_of_languages(spark, monkeypatch):
    """In groups as in one pass; more than MAX_LANGUAGES are no error without a limit."""
    rows = [(i, f"{chr(97 + i % 40 // 2)}{'xyz'[i % 3]}{i % 40} " .translate({48 + d: 107 + d for d in range(10)}) * 20, f"l{i % 40}", 0, "")
            for i in range(200)]
    rows += [(900, None, None, 0, ""), (901, "123", "l1", 0, ""), (None, "ax b", None, 0, ""), (1, rows[1][1], "l1", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    grouped = sorted(map(str, ((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in L.predicted(docs, limit=None).collect())))
    assert len(grouped) == len(rows) and len({g.split(", ")[2] for g in grouped}) > L.MAX_LANGUAGES
    monkeypatch.setattr(L, "MAX_LANGUAGES", 50)
    whole = sorted(map(str, ((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in L.predicted(docs, limit=None).collect())))
    assert grouped == whole


def test_letters_beyond_the_basic_plane():
    """Symbols and marks alone are no letters; letters fold and count."""
    models = [L.Parser(L.Folder.codes("ab abc cab b"))]
    assert not L.entropies(["\U0001F600\U0001F680 \U0001F600", "\u0301\u0302", "\U0001D7D8\U0001D6C1", "\U0010FFFF"], models).any()
    assert L.entropies(["\U00010400", "a\u0301", "\U00020000"], models).all()
    assert L.Folder.codes("\U00010400\U0001F600").tolist() == [0x10428, L.BREAK]


def test_sample_reads_beyond_a_shared_beginning(spark):
    banner = "the cat and the dog sit here " * 80  # longer than a part
    rows = [(i, banner + f"der hund und katze nummer {chr(97 + i)} " * 300, "de", 0, "") for i in range(26)]
    rows += [(100 + i, "the cat and a mouse " * 30 + chr(97 + i), "en", 0, "") for i in range(26)]
    docs = spark.createDataFrame([*rows, (900, "der hund und katze " * 5, None, 0, ""), (901, "the cat and the mouse", None, 0, "")], SCHEMA)
    parts = L.samples(docs, "doc_id", "text", "lang").where("lang = 'de'").collect()
    assert sum("hund" in r.text for r in parts) > len(parts) / 2 and all(len(r.text) == L.PART for r in parts)
    got = {r.doc_id: r.lang_pred for r in L.predicted(docs).collect()}
    assert got[900] == "de" and got[901] == "en"
