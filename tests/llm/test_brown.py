"""Op4: counts and probabilities against plain Python, the exchange."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from dossier.llm import brown as B

SCHEMA = "doc_id long, text string, chunk long, word string, held_out string, N int"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", low)] + [b""]


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def likelihood(pairs, of):
    m = np.eye(24)[of]
    t = m.T @ pairs @ m
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return f(t) - f(t.sum(0)) - f(t.sum(1))


def test_exchange_climbs_to_a_local_best():
    rng = np.random.default_rng(3)
    kind = np.arange(24) % 3
    pairs = rng.poisson(0.3 + 30 * (kind[:, None] != kind[None]) * (kind[:, None] + 1 == kind[None]), (24, 24)).astype(float)
    of = B.exchange(pairs, 3, 50)
    best = likelihood(pairs, of)
    for u in range(24):  # no single move is better
        for c in range(3):
            other = of.copy()
            other[u] = c
            assert likelihood(pairs, other) <= best + 1e-6


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(5)
    kind = rng.permutation(np.arange(30) % 2)
    pairs = rng.poisson(1 + 40 * (kind[:, None] != kind[None]), (30, 30)).astype(float)
    of = B.exchange(pairs, 2, 50)
    assert len({(a, b) for a, b in zip(of.tolist(), kind.tolist())}) == 2


def test_corpus(spark, sf):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    count = Counter(w for d, t in text.items() if not held(d) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    rows = {r.doc_id: r for r in B.op4_brown_classes(spark, sf).collect()}
    assert rows.keys() == text.keys()
    for d, r in rows.items():
        ws = tokens(text[d])
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(d), len(ws), sum(w in count for w in ws), n)
        assert abs(r.base_score - base) < 1e-6 * len(ws)
        assert r.score < 0 and abs(r.perplexity - 10 ** (-r.score / len(ws))) < 1e-6 * r.perplexity
    out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_sum_to_one(spark, sf):
    """After any class, over all known words and one unseen word a class."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    chunks = B.chunked(docs, "doc_id", "text")
    words = B.with_units(B.counted(chunks))
    model = B.trained(words, B.looked_up(chunks, words))
    rows = words.where("first and total > 0").select("total", "unit").collect()
    mass = np.zeros(B.CLASSES)
    for r in rows:
        c = model.classes[r.unit]
        mass[c] += (r.total + 1) / 10 ** model.emission[c]
    mass += 1 / 10 ** model.emission
    assert np.allclose(mass, 1) and np.allclose((10 ** model.transitions).sum(axis=1), 1)
    assert model.tokens == sum(r.total for r in rows) and model.words == len(rows)


def test_chunks_do_not_matter(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c{i % 5} " * (i % 7), 0, "", "", 1) for i in range(40)], SCHEMA).coalesce(1)
    whole = sorted(map(tuple, B.scored(docs).collect()))
    monkeypatch.setattr(B.Chunk, "full", lambda self: self.tokens >= 20)
    assert np.allclose(np.array([r[2:] for r in sorted(map(tuple, B.scored(docs).collect()))], float),
                       np.array([r[2:] for r in whole], float))


def test_edges(spark):
    long = "w " * 150_000
    docs = spark.createDataFrame([(None, "A a", 0, "", "", 1), (1, None, 0, "", "", 1), (1, "", 0, "", "", 1), (2, " \n", 0, "", "", 1),
                                  (3, long, 0, "", "", 1), (3, long, 0, "", "", 1)], SCHEMA)
    out = B.scored(docs)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    got = sorted((r.doc_id or 0, r.n_tokens) for r in out.collect())
    assert got == [(0, 3), (1, 1), (1, 1), (2, 1), (3, 150_001), (3, 150_001)]
    only = [d for d in range(100) if held(d)][:2]
    none = B.scored(spark.createDataFrame([(d, "x y", 0, "", "", 1) for d in only], SCHEMA)).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in none)
    assert B.scored(docs.limit(0)).collect() == []


def test_rare_words_get_a_class_of_their_own(spark):
    """2,600 words of one ending, three times each, half of them used as some 20 frequent words are, half as
    20 others: beyond any number of frequent words, a word goes to the class that has its neighbours."""
    letters = "abcdefghijk"
    ends = [a + b + c for a in letters for b in letters for c in letters]
    kinds = [[f"{k}{e}ing" for e in ends[:1300]] for k in "xy"]
    often = [[f"{k}{e}" for e in ends[at:at + 20]] for k, at in (("p", 0), ("q", 400))]
    marks = ["left", "right"]
    texts = [f"{marks[k]} {w} {marks[1 - k]}" for k in (0, 1) for w in kinds[k] * 3 + often[k] * 300]
    ids = [d for d in range(2 * len(texts)) if not held(d)][:len(texts)]
    docs = spark.createDataFrame([(d, t, 0, "", "", 1) for d, t in zip(ids, texts)], SCHEMA).coalesce(1)
    chunks = B.chunked(docs, "doc_id", "text")
    words = B.with_units(B.counted(chunks))
    names = chunks.where("word is not null").select("chunk", "number", "word")
    of = {bytes(r.word).decode(): r.unit for r in words.join(names, ["chunk", "number"]).collect()}
    one, two = ({of[w] for w in k} for k in kinds)
    assert not one & two and one <= {of[w] for w in often[0]} and two <= {of[w] for w in often[1]}


def test_counts_as_powers():
    n = np.array([1, 2, 3, 0, 32_768, 100_000, 65_537])
    place, exponent = B.powers(n)
    assert np.array_equal(np.bincount(place, 1 << exponent, len(n)).astype(int), n) and (np.diff(place) >= 0).all()


def test_word_wise_moves_by_hand():
    """Each word goes where the likelihood with its pairs moved there is greatest."""
    rng = np.random.default_rng(2)
    table = rng.integers(30, 60, (4, 4)).astype(float)
    home, near = np.array([0, 2, 3]), rng.integers(0, 9, (3, 2, 4))
    got = B.best_classes(table, home, near)
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    for w, h in enumerate(home):
        at = []
        for c in range(4):
            col, row = table.copy(), table.copy()
            col[:, h] -= near[w, 0]
            col[:, c] += near[w, 0]
            row[h] -= near[w, 1]
            row[c] += near[w, 1]
            at.append(f(col) - f(col.sum(0)) + f(row) - f(row.sum(1)))
        assert got[w] == np.argmax(at)
