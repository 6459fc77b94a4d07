"""Op8 against brute force: fingerprints, the chain filter, groups."""

import itertools
import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from dossier.llm import simhash as S

DOCS = "doc_id long, text string, fp long, root string, Rid int, component_id int"


def spec(text, k=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [words[i:i + k] for i in range(len(words) - k + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAÉé \n\x1c\xa0", max_size=60))
def test_fingerprint(text):
    assert S.simhash(text.encode().lower().split(), 3) % (1 << 64) == spec(text)


def test_blocks_do_not_matter(monkeypatch):
    words = [b"%d" % (i % 37) for i in range(500)]
    whole = S.simhash(words, 3)
    monkeypatch.setattr(S, "BLOCK", 7)
    assert S.simhash(words, 3) == whole


@pytest.mark.parametrize("segments,bits", [(3, 2), (5, 2), (7, 3), (4, 1)])
def test_every_near_pair_has_a_viable_chain(segments, bits):
    rng = random.Random(1)
    for _ in range(3000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits)))
        assert any(not x & key and all((x & m).bit_count() <= n for m, n in chain)
                   for key, chain in S.rings(segments, bits))


def brute(fps, bits):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for a, b in itertools.combinations(sorted(root), 2):
        if ((a ^ b) % (1 << 64)).bit_count() <= bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {f: find(f) for f in root}


@pytest.mark.parametrize("bits,bucket", [(2, 64), (2, 2), (1, 2), (3, 2), (3, 64)])
def test_groups(spark, bits, bucket):
    rng = random.Random(bits)
    fps = [rng.getrandbits(64) - (1 << 63) for _ in range(60)]
    for f in fps[:20]:  # chains and dense groups
        for _ in range(8):
            f ^= S._signed(1 << rng.randrange(64)) if rng.random() < .6 else S._signed(1 << 63 | 1 << rng.randrange(63))
            fps.append(f)
    fps += [0, -1, 1, 3, 7]
    df = spark.createDataFrame([(f,) for f in {*fps}], "fp long")
    edges = S.links(df, bits, bucket=bucket, segments=5)
    assert all(r.a < r.b and ((r.a ^ r.b) % (1 << 64)).bit_count() <= bits for r in edges.collect())
    want = brute(fps, bits)
    got = {r.node: r.root for r in S.components(edges).collect()}
    assert {f: got.get(f, f) for f in want} == want


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 900), (300, 900)], "a long, b long")
    got = {r.node: r.root for r in S.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {500: 300, 900: 300}


def rows(spark):
    long = " ".join(str(i % 5000) for i in range(100_000))
    return spark.createDataFrame([
        (5, "A b c d e", 1, "r", 1, 1), (3, "a B c d e", 1, "r", 1, 1), (3, "a b c d e", 1, "r", 1, 1),
        (None, "a b c d e", 1, "r", 1, 1), (None, "only here twice ok", 1, "r", 1, 1),
        (7, "", 1, "r", 1, 1), (6, None, 1, "r", 1, 1), (8, " \n", 1, "r", 1, 1), (9, long, 1, "r", 1, 1),
        (10, long, 1, "r", 1, 1), (11, "two words", 1, "r", 1, 1)], DOCS)


def test_edges(spark):
    out = S.near_duplicates(rows(spark))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    got = [(r.doc_id if r.doc_id is not None else -1, r.component_id) for r in out.collect()]
    assert len(got) == 11 and set(got) == {
        (5, 3), (3, 3), (-1, 3), (-1, None), (7, 6), (6, 6), (8, 6), (9, 9), (10, 9), (11, 11)}
    kept = S.drop_near_duplicates(rows(spark))
    assert kept.columns == rows(spark).columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 6, 9, 11]
    empty = spark.createDataFrame([], DOCS)
    assert S.near_duplicates(empty).collect() == [] and S.drop_near_duplicates(empty).collect() == []


def test_corpus(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    fps = {d: spec(t) for d, t in text.items()}
    root = brute([f - (1 << 64) if f >> 63 else f for f in fps.values()], 2)
    least = {}
    for d, f in fps.items():
        r = root[f - (1 << 64) if f >> 63 else f]
        least[r] = min(d, least.get(r, d))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()}
    assert got == {d: (f"{f:016x}", least[root[f - (1 << 64) if f >> 63 else f]]) for d, f in fps.items()}
