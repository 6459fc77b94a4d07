"""Op5: counts against a plain reading of their definitions, the forest, the filter."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dossier.llm import rules as R

SCHEMA = "doc_id long, text string, score double, kept string, n_words int, ID2 int"


def spec(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    held = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(held)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é\n\x1c\xa0\t#|É!", max_size=60) | st.text(max_size=30))
def test_counts(text):
    text = text.encode("utf-8", "ignore").decode()
    assert R.counts(text)[:5] == spec(text)


def test_many_distinct_words(monkeypatch):
    words = [b"%d" % (i % 700) for i in range(2000)]
    want = R.repeated_words(words)
    monkeypatch.setattr(R, "REDUCE", 10)
    assert R.repeated_words(words) == want == 2000


def test_forest_isolates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    f = R.Forest(x, 50, 128)
    usual, odd = f.score(x), f.score(np.array([[9.0, 9, 9], [7, -8, 8]]))
    assert odd.min() > np.quantile(usual, 0.99) and abs(np.median(usual) - 0.45) < 0.08
    flat = R.Forest(np.ones((10, 2)), 5, 256)
    assert np.isfinite(flat.score(np.ones((3, 2)))).all()
    assert np.isfinite(R.Forest(np.ones((1, 2)), 5, 256).score(np.ones((3, 2)))).all()


def test_path_lengths_by_hand():
    assert R.normal_path(1) == 0 and R.normal_path(2) == 1
    assert abs(R.normal_path(256) - (2 * sum(1 / i for i in range(1, 256)) - 2 * 255 / 256)) < 0.01


def test_corpus(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in R.op5_quality_rules(spark, sf).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == text.keys()
    for d, r in rows.items():
        want = spec(text[d])
        assert [r[c] for c in R.COUNTS[:5]] == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)
    known = [(r.quality, rows[r.doc_id]) for r in labels.collect()]
    good = [r.kept for q, r in known if q and not r.base_failed]
    bad = [r.kept for q, r in known if not q]
    assert sum(good) >= 0.9 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_edges(spark):
    clean = " ".join(f"Word{i} and more" for i in range(60))
    rows = [(1, clean, 0.0, "", 1, 1), (1, clean, 0.0, "", 1, 1), (2, None, 0.0, "", 1, 1), (3, "", 0.0, "", 1, 1),
            (None, clean, 0.0, "", 1, 1), (4, "same " * 100, 0.0, "", 1, 1), (5, clean * 400, 0.0, "", 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(1, 1, ""), (1, 0, ""), (None, 1, ""), (9, 0, "")], "doc_id long, quality int, id string")
    out = R.judged(docs, labels).collect()
    assert len(out) == 7 and sum(r.base_failed for r in out) == 4
    none = labels.limit(0)
    kept = R.filtered(docs, none)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1]
    assert R.judged(docs.limit(0), labels).collect() == [] and R.filtered(docs.limit(0), labels).collect() == []
