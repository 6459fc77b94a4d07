"""Second-order gradient boosting on histograms (M-3).

Logistic loss: a row's gradient is p - y and its hessian p (1 - p). Features are
cut into at most ``BINS`` bins by quantiles of the training rows (nulls are the
first bin) and written once, as blocks of rows. A level of a tree is one Spark job:
every task sums gradient and hessian per (node, feature, bin) over its rows into one
table a node, a node's tables are added up, and it is split where the regularised gain

    GL^2 / (HL + L2) + GR^2 / (HR + L2) - G^2 / (H + L2)

is greatest; both sides keep a hessian of ``MIN_HESSIAN`` at least. The driver sees
one line a node, its split and its sums. A leaf is
-G / (H + L2), times the step. Rows carry the margin of the trees of earlier
stages; it is written anew every ``STAGED`` trees, so no job recomputes more
than these."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.operators.net import matrix
from dossier.session import materialize

#: The usual defaults: rounds, depth, step, L2 penalty, least hessian of a child.
ROUNDS, DEPTH, STEP, L2, MIN_HESSIAN = 100, 6, 0.3, 1.0, 1.0
BINS, STAGED = 256, 20
#: Rows that one task sums alone.
ROWS_PER_TASK = 50_000
#: Gains below this are rounding, not structure.
NO_GAIN = 1e-9


@dataclass
class Tree:
    """Nodes in breadth order: children of i are 2i + 1 and 2i + 2. ``feature`` is
    -1 for a leaf; a row goes left if its bin is at most ``cut``."""
    feature: np.ndarray = field(default_factory=lambda: np.full(2 ** (DEPTH + 1) - 1, -1))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(2 ** (DEPTH + 1) - 1, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(2 ** (DEPTH + 1) - 1))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node each row has come to."""
        at = np.zeros(len(bins), np.int64)
        while True:
            feature = self.feature[at]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                return at
            left = bins[inner, feature[inner]] <= self.cut[at[inner]]
            at[inner] = 2 * at[inner] + np.where(left, 1, 2)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins)]


@dataclass
class Model:
    edges: list[np.ndarray]
    trees: list[Tree]
    base: float


def best_split(g: np.ndarray, h: np.ndarray, l2: float = L2, least: float = MIN_HESSIAN) -> tuple[float, int, int]:
    """(gain, feature, cut) of one node's sums, arrays of feature x bin; gain 0 for none."""
    gl, hl = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
    total_g, total_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    gr, hr = total_g - gl, total_h - hl
    gain = gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - total_g ** 2 / (total_h + l2)
    gain = np.where((hl >= least) & (hr >= least), gain, -np.inf)
    if not gain.size or gain.max() <= NO_GAIN:
        return 0.0, -1, 0
    at = int(gain.argmax())
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


def leaf(g: float, h: float, step: float) -> float:
    return -step * g / (h + L2)


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin 0 for null, then 1 + how many edges lie below the value."""
    out = np.empty(x.shape, np.int64)
    for i, e in enumerate(edges):
        out[:, i] = np.where(np.isnan(x[:, i]), 0, 1 + np.searchsorted(e, x[:, i], side="left"))
    return out


def features_column(features: Sequence[str]) -> F.Column:
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])


def quantiles(rows: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    share = [i / (BINS - 1) for i in range(1, BINS - 1)]
    got = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), share, 10_000).alias(f"q{i}")
                     for i, c in enumerate(features)]).first()
    return [np.unique(np.array(got[f"q{i}"] or [], np.float64)) for i in range(len(features))]


BLOCKS = "bins binary, y binary, margin binary"
SPLITS = "node long, g double, h double, gain double, feature long, cut long, gl double, hl double, gr double, hr double"


def blocks(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins, labels and margins of each block of staged rows."""
    for b in batches:
        for bins, y, margin in zip(*(b.column(c).to_pylist() for c in ("bins", "y", "margin")), strict=True):
            yield np.frombuffer(bins, np.int16).reshape(-1, n_features).astype(np.int64), np.frombuffer(y), np.frombuffer(margin)


def block(bins: np.ndarray, y: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    parts = (bins.astype(np.int16), y.astype(np.float64), margin.astype(np.float64))
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], ["bins", "y", "margin"])


def split_row(node: int, both: np.ndarray) -> list[float]:
    """A node's line of ``SPLITS`` from its sums, 2 x feature x bin."""
    g, h = both
    gain, f, at = best_split(g, h)
    sides = [float(x[f, side].sum()) for side in (slice(at + 1), slice(at + 1, None)) for x in (g, h)] if f >= 0 else [0.0] * 4
    return [node, float(g[0].sum()), float(h[0].sum()), gain, f, at, *sides]


def splits(rows: DataFrame, trees: list[Tree], growing: Tree, level: int, n_features: int, widest: int,
           tasks: int) -> list:
    """The lines of the nodes of one ``level`` of ``growing`` that have rows."""
    first, shape = 2 ** level - 1, (2 ** level, 2, n_features, widest)
    names = [c.split()[0] for c in SPLITS.split(", ")]

    def lines(made: list[list[float]]) -> pa.Table:
        columns = list(zip(*made, strict=True)) if made else [()] * len(names)
        return pa.table({n: pa.array(c, pa.int64() if n in ("node", "feature", "cut") else pa.float64())
                         for n, c in zip(names, columns, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(shape), np.zeros(shape[0], bool)
        for bins, y, margin in blocks(batches, n_features):
            margin = margin + sum((t.margins(bins) for t in trees), 0.0)
            p = 1 / (1 + np.exp(-margin))
            at = growing.nodes(bins) - first
            here = at >= 0  # the others are in leaves of earlier levels
            at, bins, g, h = at[here], bins[here], (p - y)[here], (p * (1 - p))[here]
            seen |= np.bincount(at, minlength=len(seen)) > 0
            for i in range(n_features):
                cell = at * widest + bins[:, i]
                total[:, 0, i] += np.bincount(cell, g, len(seen) * widest).reshape(-1, widest)
                total[:, 1, i] += np.bincount(cell, h, len(seen) * widest).reshape(-1, widest)
        open_nodes = np.flatnonzero(seen).tolist()
        if tasks > 1:
            yield pa.RecordBatch.from_arrays([pa.array([n + first for n in open_nodes], pa.int64()), pa.array(
                [total[n].tobytes() for n in open_nodes], pa.binary())], ["node", "sums"])
        else:
            yield from lines([split_row(n + first, total[n]) for n in open_nodes]).to_batches()

    def added(part: pa.Table) -> pa.Table:
        both = np.zeros(shape[1:])
        for x in part.column("sums").to_pylist():
            both += np.frombuffer(x).reshape(both.shape)
        return lines([split_row(part.column("node")[0].as_py(), both)])

    if tasks <= 1:
        return rows.mapInArrow(run, SPLITS).collect()
    return rows.mapInArrow(run, "node long, sums binary").groupBy("node").applyInArrow(added, SPLITS).collect()


def fit(train: DataFrame, features: Sequence[str], label: str, rounds: int = ROUNDS, depth: int = DEPTH,
        step: float = STEP) -> Model:
    if not 1 <= depth <= DEPTH:
        raise ValueError(f"depth must be in 1..{DEPTH}")
    edges = quantiles(train, features)
    widest = 2 + max(map(len, edges), default=0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield block(binned(matrix(b.column("x")), edges), b.column("y").to_numpy(zero_copy_only=False), np.zeros(b.num_rows))

    rows = train.select(features_column(features).alias("x"), F.col(label).cast("double").alias("y"))
    # as many tasks as the rows need: each job of a level starts them all again
    tasks = max(1, -(-train.count() // ROWS_PER_TASK))
    rows = rows.coalesce(1) if tasks == 1 else rows.repartition(tasks)
    rows = materialize(rows.mapInArrow(cut, BLOCKS), "boost-rows")
    model, fresh = Model(edges, [], 0.0), []
    for _ in range(rounds):
        tree = Tree()
        for level in range(depth):
            for r in splits(rows, fresh, tree, level, len(features), widest, tasks):
                if r.node == 0:
                    tree.value[0] = leaf(r.g, r.h, step)
                if r.gain > 0:
                    tree.feature[r.node], tree.cut[r.node] = r.feature, r.cut
                    tree.value[2 * r.node + 1], tree.value[2 * r.node + 2] = leaf(r.gl, r.hl, step), leaf(r.gr, r.hr, step)
            if not (tree.feature[2 ** level - 1:2 ** (level + 1) - 1] >= 0).any():
                break
        model.trees.append(tree)
        fresh.append(tree)
        if len(fresh) == STAGED:
            rows, fresh = materialize(advanced(rows, fresh, len(features)), "boost-rows"), []
        if tree.feature[0] < 0 and abs(tree.value[0]) < NO_GAIN:
            break
    return model


def advanced(rows: DataFrame, trees: list[Tree], n_features: int) -> DataFrame:
    """``rows`` with the margins of ``trees`` added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, y, margin in blocks(batches, n_features):
            yield block(bins, y, margin + sum(t.margins(bins) for t in trees))
    return rows.mapInArrow(run, BLOCKS)


def predicted(rows: DataFrame, model: Model, features: Sequence[str]) -> DataFrame:
    """``rows`` with ``prediction``: whether the margin is above 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            margin = np.zeros(b.num_rows)
            if b.num_rows:
                bins = binned(matrix(b.column("_x")), model.edges)
                margin = margin + sum((t.margins(bins) for t in model.trees), 0.0)
            keep = [n for n in b.schema.names if n != "_x"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array((margin > 0).astype(np.int32))], [*keep, "prediction"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.withColumn("_x", features_column(features)).mapInArrow(run, f"{schema}, prediction int")


def fit_predict(train: DataFrame, test: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Fit on ``train`` and return ``test`` with an integer ``prediction``."""
    return predicted(test, fit(train, features, label), features)
