"""Op7: held-out accuracy, the normal equations, the isotonic map."""

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dossier.llm import quality as Q

SCHEMA = "doc_id long, text string, id string, y int, score string, X0 int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), min_size=1, max_size=12).filter(lambda x: any(n for n, _ in x)))
def test_isotonic(rows):
    n = np.array([a for a, _ in rows], float)
    ones = np.array([min(a, b) for a, b in rows], float)
    got = Q.isotonic(n, ones)
    assert (np.diff(got) >= -1e-12).all() and got.min() >= 0 and got.max() <= 1
    at = np.flatnonzero(n)
    # the least squares fit: the min-max formula
    for k, i in enumerate(at):
        want = max(min(ones[at[a]:at[z] + 1].sum() / n[at[a]:at[z] + 1].sum() for z in range(k, len(at))) for a in range(k + 1))
        assert abs(got[i] - want) < 1e-9


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 8))
    z = Q.Model(np.zeros(8), np.ones(8)).features(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / 2 / Q.WIDTH ** 2)
    assert np.abs(z @ z.T - want).mean() < 0.06


def test_partition_sums(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, 2)), rng.integers(0, 2, 300).astype(float)
    model = Q.Model(np.zeros(2), np.ones(2))
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "x0 double, x1 double, y double")
    a, c = Q.normal_equations(df.repartition(5), model)
    z = model.features(x)
    assert np.allclose(a, z.T @ z) and np.allclose(c, z.T @ y)


def test_corpus(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in Q.op7_quality_classifier(spark, sf).collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows.values())
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3)
    known = [(r.quality, rows[r.doc_id]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    right = [r.predicted == q for q, r in known if r.held_out]
    assert len(right) > 50 and sum(right) >= 0.95 * len(right)


def test_edges(spark):
    rows = [(i, "Some clean words here. " * 20 if i % 2 else "$$$ ### !! " * 9, "", 1, "", 1) for i in range(60)]
    rows += [(None, "x", "", 1, "", 1), (70, None, "", 1, "", 1), (71, "", "", 1, "", 1), (1, "w " * 90_000, "", 1, "", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(60)] + [(None, 1, 1), (3, None, 1)],
                                   "doc_id long, quality int, id int")
    out = Q.scored(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == 64 and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and 1 < r.doc_id < 60)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert {r.score for r in Q.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.scored(docs.limit(0), labels).collect() == []
