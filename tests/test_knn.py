"""k-NN by pivots against brute force, and how few pairs it measures."""

import numpy as np
import pytest

from dossier.operators import knn
from dossier.operators.quality import knn_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(n, dim=16, clusters=60, equal=0, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dim)) * 5
    x = middle[rng.integers(clusters, size=n)] + rng.normal(size=(n, dim)) * 0.3
    x[:equal] = x[0]
    return x.astype(np.float32)


def frames(spark, x):
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    every = spark.createDataFrame(rows, SCHEMA)
    return every.where("vec_id % 5 <> 0"), every.where("vec_id % 5 = 0")


def brute(x, k):
    ids = np.arange(len(x))
    t, q = ids[ids % 5 != 0], ids[ids % 5 == 0]
    y = x.astype(np.float64)
    out = {}
    for i in q:
        d = ((y[t] - y[i]) ** 2).sum(axis=1)
        order = np.lexsort((t, d))[:k]
        out[int(i)] = [int(v) for v in t[order]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.q_id, r.nn_rank)):
        out.setdefault(r.q_id, []).append(r.t_id)
    return out


@pytest.mark.parametrize("equal", [0, 1500])
def test_clusters(spark, equal):
    """Equal rows to brute force, also with a third of all vectors equal."""
    x = clustered(4500, equal=equal)
    train, query = frames(spark, x)
    assert got(knn.knn_pivots(train, query, k=7, block=100)) == brute(x, 7)


def test_measures_few_pairs(spark):
    x = clustered(12_000)
    train, query = frames(spark, x)
    r = knn.knn_pivots(train, query, k=7, block=100, count=True).first()
    assert r.pairs == 9600 * 2400 and r.measured < 0.2 * r.pairs


def test_no_clusters(spark):
    """Random directions: no bound excludes anything; the rows are the same."""
    x = np.random.default_rng(4).normal(size=(1500, 64)).astype(np.float32)
    train, query = frames(spark, x)
    assert got(knn.knn_pivots(train, query, k=5, block=100)) == brute(x, 5)


def test_fewer_rows_than_k(spark):
    x = clustered(30, clusters=5)
    train, query = frames(spark, x)
    small = train.where("vec_id < 8")
    a = got(knn.knn_pivots(small, query, k=20, block=2))
    assert a == got(knn_neighbours(small, query, k=20)) and all(len(v) == 6 for v in a.values())
    assert knn.knn_pivots(train.limit(0), query, k=3, block=2).collect() == []
    assert knn.knn_pivots(train, query.limit(0), k=3, block=2).collect() == []
    with pytest.raises(ValueError):
        knn.knn_pivots(train, query, k=0)


def test_reached_is_never_too_little():
    """Every row within reach stands in a block that is reached or met first."""
    x = clustered(3000, dim=8).astype(np.float64)
    pivots = knn.choose_pivots(x[:500], 40)
    d = knn.distances(x, pivots)
    cell = d.argmin(axis=1)
    dist = d[np.arange(len(x)), cell]
    cells, block_of = [], np.empty(len(x), int)
    for c in range(len(pivots)):
        rows = np.flatnonzero(cell == c)
        for part in np.array_split(rows[np.argsort(dist[rows])], max(1, len(rows) // 30)):
            if len(part):
                block_of[part] = len(cells)
                cells.append((c, len(part), dist[part].min(), dist[part].max(), 1, len(cells)))
    made = knn.Cells(pivots, *(np.array(v) for v in zip(*cells, strict=True)))
    for i in range(0, 3000, 50):
        reach = np.sort(((x - x[i]) ** 2).sum(axis=1))[9] ** 0.5
        near = np.flatnonzero(((x - x[i]) ** 2).sum(axis=1) ** 0.5 <= reach)
        met = {*made.reached(d[i], reach, 5).tolist(), *made.first[made.home(d[i], 5)].tolist()}
        assert {*block_of[near].tolist()} <= met
