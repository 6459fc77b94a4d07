"""Op6 against brute force; the masks are lossless."""

import itertools
import random
import re

import pytest

from dossier.llm import decontaminate as D

SCHEMA = "doc_id long, text string, words string, at int, KEY int, item string"


def test_masks_are_lossless():
    for bad in itertools.combinations(range(D.WINDOW), D.SUBSTITUTIONS):
        assert any(all(at + o < D.WINDOW and at + o not in bad for o in m)
                   for m in D.MASKS for at in range(D.WINDOW))


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def spec(docs, items):
    """Every shift, word by word; an item below the window must stand whole."""
    out = {}
    for d, text in docs:
        for b, item in items:
            x, y = tokens(text), tokens(item)
            for shift in range(-len(y), len(x)):
                same = [0 <= q + shift < len(x) and x[q + shift] == w for q, w in enumerate(y)]
                best = max((sum(same[s:s + D.WINDOW]) for s in range(len(same))), default=0)
                if len(y) >= D.SHORTEST and best >= min(len(y), D.ENOUGH):
                    out[d, b] = max(best, out.get((d, b), 0))
    return out


def tables(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 8, 11, 13, 20, 40])))) for i in range(12)]
    items += [(50, None), (51, ""), (None, items[3][1]), (52, items[4][1])]
    docs = []
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.randrange(30))
        part = tokens(items[rng.randrange(12)][1])
        at = rng.randrange(len(part))
        part = part[at:at + rng.randrange(10, 25)]
        for _ in range(rng.randrange(5)):
            part[rng.randrange(len(part))] = "new"
        docs.append((i, " ".join(words).upper() + " -- " + ", ".join(part) + "\n" + " ".join(words)))
    docs += [(70, None), (71, ""), (72, "..."), (None, items[2][1]), (None, "x"), (3, docs[3][1]), (73, items[11][1] * 1500)]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"broadcast_seeds": 0}, {"broadcast_rows": 0}])
def test_overlaps(spark, limits):
    docs, items = tables(spark)
    d = spark.createDataFrame([(i, t, "", 0, 1, "") for i, t in docs], SCHEMA)
    b = spark.createDataFrame([(i, t, "", 0) for i, t in items], "item_id long, text string, seed string, mask int")
    got = {(r.doc_id, r.item_id): r.equal_words for r in D.overlaps(d, b, **limits).collect()}
    assert got == spec(docs, items)
    kept = D.decontaminated(d, b, **limits)
    assert kept.columns == d.columns
    found = {k[0] for k in got}
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(
        i for i, _ in docs if i is not None and i not in found)
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["x"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 40, "", 0, 1, "")], SCHEMA)
    items = spark.createDataFrame([(1, "a " * 40)], "item_id long, text string")
    assert D.overlaps(docs.limit(0), items).collect() == [] and D.overlaps(docs, items.limit(0)).collect() == []
    assert D.decontaminated(docs, items.limit(0)).count() == 1 and D.overlaps(docs, items).count() == 1


@pytest.mark.parametrize("limits", [{}, {"broadcast_seeds": 0}])
def test_one_item_over_and_over(spark, limits):
    """100,000 words of one item: memory holds shifts, not words times hits."""
    item = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, " ".join([item] * 2500)), (2, "word1 " * 100_000)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, "word1 " * 30), (9, item.replace("word9", "x"))], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.equal_words) for r in D.overlaps(docs, items, **limits).collect()}
    assert got == {(1, 7, 13), (2, 8, 13), (1, 9, 13)}


def test_short_items_stand_whole(spark):
    docs = spark.createDataFrame([(1, "x one two, Three four five y"), (2, "one two three four six"), (3, "one two three four five")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "One two three four five?"), (2, "three four")], "item_id long, text string")
    assert sorted(map(tuple, D.overlaps(docs, items).collect())) == [(1, 1, 5), (3, 1, 5)]


def test_no_python_and_only_hits_are_shuffled(spark, sf):
    p = D.op6_decontamination(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in p and "Arrow" not in p and "Cartesian" not in p
