"""Quality classifier on random Fourier features (operator 7).

Document statistics (length, shares of symbols, capitals, letters, marks and
repetition) are standardised and mapped to ``FEATURES`` cosines of random
projections, whose inner products approximate a Gaussian kernel. Ridge
regression on them is a linear system: every partition sums its own part of
the normal equations, the parts are added up row by row on Spark, and only the
finished system of fixed size reaches the driver. The raw scores of a second
set of labelled rows, counted in ``BINS`` steps, give an isotonic
(never falling) map to probabilities.

Labelled rows are parted by crc32(id) modulo 5: remainder 0 is held out, 1
calibrates, the others fit. All labelled rows are used and every document is
scored; nothing but labelled rows and sums is shuffled.

Inputs and their results: a null or empty text has all statistics zero and is
scored like any other; long texts are counted whole; repeated rows score
alike; a null id has no label and is not held out; a document with several
labels counts once for each; with no row to fit on every score is 0.5, with
none to calibrate on the raw score is cut to 0..1; an empty table gives an
empty one; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.base import fold, stage, table
from dossier.llm.rules import statistics

FEATURES, WIDTH, RIDGE, BINS = 256, 2.0, 1.0, 2000
HELD_OUT, CALIBRATE, FOLDS = 0, 1, 5
THRESHOLD = 0.3
#: Raw scores and standardised statistics beyond these count as these.
RAW, FAR = (-0.5, 1.5), 6.0


def inputs() -> list[Column]:
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.col(a) / F.when(F.col(b) > 0, F.col(b)), F.lit(0.0))
    return [F.log1p("n_words"), share("word_chars", "n_words"), F.sqrt(share("n_symbols", "word_chars")),
            share("n_repeat_words", "n_words"), share("n_dup_lines", "n_words"), share("n_upper", "n_letters"),
            share("n_letters", "word_chars"), F.sqrt(share("n_marks", "word_chars"))]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    steps: np.ndarray | None = None  # calibrated probability of each raw step

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(0)
        directions = rng.normal(0, 1 / WIDTH, (x.shape[1], FEATURES))
        phases = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -FAR, FAR)
        cosines = np.cos(z @ directions + phases) * np.sqrt(2 / FEATURES)
        return np.hstack([cosines, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, *RAW)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        raw = self.raw(x)
        return np.clip(raw, 0, 1) if self.steps is None else self.steps[step_of(raw)]


def step_of(raw: np.ndarray) -> np.ndarray:
    return np.minimum(((raw - RAW[0]) / (RAW[1] - RAW[0]) * BINS).astype(np.int64), BINS - 1)


def matrix(b: pa.RecordBatch) -> np.ndarray:
    return np.stack([c.to_numpy() for n, c in zip(b.schema.names, b.columns) if n.startswith("x")], axis=1)


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray] | None:
    """A = Z'Z and c = Z'y over ``rows`` (x0, x1, ..., y); None without rows."""
    size = FEATURES + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for b in batches:
            z = model.features(matrix(b))
            total[:, :size] += z.T @ z
            total[:, size] += z.T @ b.column("y").to_numpy()
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total))], ["i", "v"])

    def add(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        v = np.sum(np.stack(t.column("v").to_numpy()), axis=0)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "v": pa.array([v])})

    schema = "i int, v array<double>"
    sums = rows.mapInArrow(part, schema).groupBy("i").applyInArrow(add, schema).orderBy("i").collect()
    if not sums:
        return None
    v = np.array([r.v for r in sums])
    return v[:, :size], v[:, size]


def isotonic(n: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Never falling probabilities per step, by pooling steps that fall;
    between steps with rows it is linear."""
    blocks: list[list[float]] = []  # rows, ones, first and last step
    for i in np.flatnonzero(n):
        blocks.append([n[i], ones[i], i, i])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    at = [x for b in blocks for x in (b[2], b[3])]
    return np.interp(np.arange(len(n)), at, [b[1] / b[0] for b in blocks for _ in range(2)])


def fitted(stats: DataFrame, labels: DataFrame) -> Model:
    """The model from ``stats`` (staged: id and counts) and ``labels`` (id, y)."""
    at = fold("id", FOLDS)
    columns = [c.alias(f"x{i}") for i, c in enumerate(inputs())]
    known = stage(stats.join(labels.where("id is not null and y is not null"), "id").where(at != HELD_OUT)
                  .select(*columns, F.col("y").cast("double").alias("y"), (at == CALIBRATE).alias("later")), "labelled")
    fit, later = known.where("not later").drop("later"), known.where("later").drop("later")
    names = [c for c in fit.columns if c != "y"]
    moments = fit.agg(*[f(c) for f in (F.mean, F.stddev_pop) for c in names]).first()
    if moments[0] is None:
        return Model(np.zeros(len(names)), np.ones(len(names)))
    scale = np.array(moments[len(names):])
    model = Model(np.array(moments[:len(names)]), np.where(scale > 1e-9, scale, 1.0))
    a, c = normal_equations(fit, model)
    model.weights = np.linalg.solve(a + RIDGE * np.eye(len(a)), c)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(step_of(model.raw(matrix(b)))), b.column("y")], ["step", "y"])

    counted = later.mapInArrow(steps, "step long, y double").groupBy("step").agg(
        F.count("*").alias("n"), F.sum("y").alias("ones")).collect()
    if counted:
        n, ones = np.zeros(BINS), np.zeros(BINS)
        for r in counted:
            n[r.step], ones[r.step] = r.n, r.ones
        model.steps = isotonic(n, ones)
    return model


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           good: str = "quality") -> DataFrame:
    """(id, held_out, score, predicted) per row; ``good`` is a 0/1 expression over ``labels``."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    stats = stage(statistics(plain, "text", ["id"]), "quality-statistics")
    model = fitted(stats, labels.select(F.col(id_col).alias("id"), F.expr(good).cast("int").alias("y")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(model.score(matrix(b)))], ["id", "score"])

    schema = T.StructType([stats.schema["id"], T.StructField("score", T.DoubleType())])
    out = stats.select("id", *[c.alias(f"x{i}") for i, c in enumerate(inputs())]).mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), F.coalesce(fold("id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op7_quality_classifier": op7_quality_classifier}
ORACLE: dict[str, str] = {}
