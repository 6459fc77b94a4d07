"""The dense net as given (M-5): relu layers with dropout, a sigmoid output,
binary cross-entropy, Adam, mini-batches; trained on all partitions at once.

Every epoch is one Spark job. Each task starts from the same weights and Adam
moments, goes through its rows in mini-batches (an Arrow batch at a time, so its
memory doesn't grow with the rows), and returns what it has come to; weights and
moments are averaged by the rows behind them in one aggregate, so what reaches
the driver is one model, however many tasks there are. With one partition this is
plain mini-batch Adam. The training rows are standardised by their own means and
deviations and written once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.session import materialize

# --- fixed values that must equal the reference ------------------------------
DROPOUT = 0.2
# hidden layers, epochs and mini-batch rows, for all rows and for a subset of them
ALL_ROWS, SUBSET = ((64, 32, 16), 35, 64), ((32, 16), 18, 32)
# --- end of fixed values -------------------------------------------------------
#: Adam's usual step and decay.
STEP, DECAY1, DECAY2, TINY = 0.001, 0.9, 0.999, 1e-7
#: Rows a task should have at least, so that its epoch has enough mini-batches.
ROWS_PER_TASK = 2_048


@dataclass(frozen=True)
class Net:
    """A net's layer sizes and its weights as one vector: per layer the matrix, then the offsets."""
    sizes: tuple[int, ...]
    weights: np.ndarray

    @staticmethod
    def start(n_features: int, hidden: Sequence[int], seed: int) -> Net:
        sizes = (n_features, *hidden, 1)
        rng = np.random.default_rng(seed)
        parts = []
        for a, b in zip(sizes, sizes[1:], strict=False):
            limit = np.sqrt(6 / (a + b))
            parts += [rng.uniform(-limit, limit, a * b), np.zeros(b)]
        return Net(sizes, np.concatenate(parts))

    def layers(self) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in zip(self.sizes, self.sizes[1:], strict=False):
            out.append((self.weights[at:at + a * b].reshape(a, b), self.weights[at + a * b:at + a * b + b]))
            at += a * b + b
        return out

    def chances(self, x: np.ndarray) -> np.ndarray:
        for w, c in self.layers()[:-1]:
            x = np.maximum(x @ w + c, 0)
        w, c = self.layers()[-1]
        return 1 / (1 + np.exp(-np.clip((x @ w + c)[:, 0], -500, 500)))

    def gradient(self, x: np.ndarray, y: np.ndarray, keep: list[np.ndarray] | None = None) -> np.ndarray:
        """Of the mean cross-entropy; ``keep`` is what dropout leaves of each hidden layer."""
        layers = self.layers()
        inputs, active = [x], []
        for i, (w, c) in enumerate(layers[:-1]):
            z = inputs[-1] @ w + c
            on = (z > 0) * (keep[i] if keep else 1.0)
            active.append(on)
            inputs.append(z * on)
        w, c = layers[-1]
        p = 1 / (1 + np.exp(-np.clip((inputs[-1] @ w + c)[:, 0], -500, 500)))
        back = ((p - y) / len(y))[:, None]
        parts: list[np.ndarray] = []
        for i in range(len(layers) - 1, -1, -1):
            parts = [(inputs[i].T @ back).ravel(), back.sum(axis=0), *parts]
            if i:
                back = back @ layers[i][0].T * active[i - 1]
        return np.concatenate(parts)


def adam(net: Net, m: np.ndarray, v: np.ndarray, gradient: np.ndarray, t: int) -> tuple[Net, np.ndarray, np.ndarray]:
    m, v = DECAY1 * m + (1 - DECAY1) * gradient, DECAY2 * v + (1 - DECAY2) * gradient ** 2
    step = STEP * (m / (1 - DECAY1 ** t)) / (np.sqrt(v / (1 - DECAY2 ** t)) + TINY)
    return Net(net.sizes, net.weights - step), m, v


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def fit(rows: DataFrame, n_features: int, hidden: Sequence[int], epochs: int, batch: int, seed: int = 0,
        dropout: float = DROPOUT) -> Net:
    """A net for ``rows`` (x array<double>, y)."""
    n = rows.count()
    if not n:
        raise ValueError("no training rows")
    tasks = max(1, min(n // ROWS_PER_TASK, rows.sparkSession.sparkContext.defaultParallelism))
    rows = rows.select("x", F.col("y").cast("double").alias("y"))
    # one task's rows need no exchange and no average
    rows = materialize(rows.coalesce(1) if tasks == 1 else rows.repartition(tasks, F.xxhash64("x", "y")), "net-rows")
    net = Net.start(n_features, hidden, seed)
    m, v, t = np.zeros_like(net.weights), np.zeros_like(net.weights), 0
    for epoch in range(epochs):
        def run(batches: Iterator[pa.RecordBatch], net=net, m=m, v=v, t=t, epoch=epoch) -> Iterator[pa.RecordBatch]:
            seen, steps = 0, t
            for b in batches:
                x, y = matrix(b.column("x")), b.column("y").to_numpy(zero_copy_only=False)
                rng = np.random.default_rng([seed, epoch, seen, len(y)])
                order = rng.permutation(len(y))
                for s in range(0, len(order), batch):
                    some = order[s:s + batch]
                    keep = [(rng.random((len(some), k)) >= dropout) / (1 - dropout) for k in hidden]
                    steps += 1
                    net, m, v = adam(net, m, v, net.gradient(x[some], y[some], keep), steps)
                seen += len(y)
            if seen:
                size = len(net.weights)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(size + 1)), pa.array(np.append(net.weights, steps)), pa.array(np.append(m, 0)),
                     pa.array(np.append(v, 0)), pa.array(np.full(size + 1, float(seen)))], ["i", "w", "m", "v", "n"])
        made = rows.mapInArrow(run, "i long, w double, m double, v double, n double")
        if tasks > 1:
            made = made.groupBy("i").agg(*[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in "wmv"])
        got = made.toPandas().sort_values("i")
        w = got["w"].to_numpy()
        net, m, v, t = Net(net.sizes, w[:-1]), got["m"].to_numpy()[:-1], got["v"].to_numpy()[:-1], int(round(w[-1]))
    return net


def predicted(rows: DataFrame, net: Net) -> DataFrame:
    """``rows`` with ``prediction``: whether the chance of class 1 is over a half."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = net.chances(matrix(b.column("x"))) if b.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array((p > 0.5).astype(np.int32))], [*b.schema.names, "prediction"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, prediction int")


def standardised(train: DataFrame, test: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both with ``x``: the features less the training rows' mean, over their deviation; nulls are 0."""
    stats = train.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(features) for k, f in (("m", F.avg), ("d", F.stddev_pop))]).first()
    x = F.array(*[F.coalesce((F.col(c) - (stats[f"m{i}"] or 0.0)) / (stats[f"d{i}"] or 1.0), F.lit(0.0)).cast("double")
                  for i, c in enumerate(features)])
    return train.withColumn("x", x), test.withColumn("x", x)


def fit_predict(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, seed: int = 0,
                subset: bool = False) -> DataFrame:
    """Fit on ``train`` and return ``test`` with an integer ``prediction``."""
    hidden, epochs, batch = SUBSET if subset else ALL_ROWS
    train, test = standardised(train, test, features)
    net = fit(train.select("x", F.col(label).alias("y")), len(features), hidden, epochs, batch, seed)
    return predicted(test, net).drop("x")
