"""Exact k-NN below all pairs: pivots, cells, rings and triangle bounds (J-6, M-4).

Training rows are dealt to the cell of their nearest pivot, each cell is cut
into rings by the distance to its pivot, and a ring with too many rows (equal
vectors, a dense spot) into slices by hash; a ring's slice is a block of about
``BLOCK`` rows. A query row first meets the ring it lies in, which gives it k
neighbours and the distance ``reach`` of the k-th; after that it is sent only to
blocks that may hold a row within reach:

* cell: |d(q, p) - d(t, p)| <= d(q, t) for the cell's pivot p, and
  (d(q, p)^2 - d(q, home)^2) / (2 d(p, home)) <= d(q, t), since t lies on p's
  side of the plane between p and the query's own pivot;
* ring and row: the first bound with the ring's least and greatest distance,
  then with the row's own, inside the block.

Training rows move once, to their block; query rows go to the blocks they reach.
A block that very many query rows reach is split by a hash of the query, and only
such a block has copies. Pivots come from a bounded sample of training rows
(``SAMPLE``, by hash); they steer the work and never the result. What is
gathered is bounded: pivots, at most ``MAX_PIVOTS``, and one line per ring, at
most twice ``MAX_BLOCKS`` plus the pivots.

Where the vectors have no clusters (random directions in many dimensions), all
distances are alike and no triangle bound excludes anything. A sample of query
rows shows how many blocks they reach; if sending them there would move more rows
than blocks of all pairs do, the rest is done by ``quality.knn_neighbours``. Both
ways give the same rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators.quality import KNN_QUERY_CELL, KNN_TRAIN_CELL, knn_neighbours, nearest_rows
from dossier.session import materialize

SAMPLE, MAX_PIVOTS = 20_000, 2_000
BLOCK, MAX_BLOCKS = 4_096, 100_000
#: Query rows per copy of a block, and rows of the sample that choose the plan.
PER_COPY, PLAN_SAMPLE = 20_000, 1_000
#: Bounds are widened by this share, which exceeds the rounding of a distance.
SLACK = 1e-9


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """All distances to the pivots; rounding is that of differences, not of squares."""
    out = np.empty((len(x), len(pivots)))
    for i in range(0, len(x), 64):
        diff = x[i:i + 64, None] - pivots[None]
        out[i:i + 64] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` pivots of a sample: each next one the row farthest from those
    before (so no cluster is missed), then two rounds of means."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    pivots = sample[chosen]
    for _ in range(2):
        near = (-2 * sample @ pivots.T + (pivots ** 2).sum(axis=1)).argmin(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, near, sample)
        sizes = np.bincount(near, minlength=len(pivots))
        pivots = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], pivots)
    return pivots


@dataclass(frozen=True)
class Cells:
    """Pivots and rings: per ring its cell, rows, least and greatest distance,
    number of slices and first block number; rings stand cell by cell."""
    pivots: np.ndarray
    cell: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    slices: np.ndarray
    first: np.ndarray

    def gap(self, d: np.ndarray) -> np.ndarray:
        """Per ring the least |d(q, p) - d(t, p)| of a query row at ``d`` from the pivots."""
        at = d[self.cell]
        return np.maximum(0.0, np.maximum(at - self.high, self.low - at))

    def home(self, d: np.ndarray, k: int) -> list[int]:
        """Rings a query row meets first: of its own cell, then of the next, by
        gap, until they hold k rows."""
        out, found = [], 0
        for c in np.argsort(d, kind="stable"):
            rings = np.flatnonzero(self.cell == c)
            at = d[c]
            for r in rings[np.argsort(np.maximum(0.0, np.maximum(at - self.high[rings], self.low[rings] - at)), kind="stable")]:
                out.append(int(r))
                found += int(self.rows[r] if self.slices[r] == 1 else self.rows[r] // self.slices[r])
                if found >= k:
                    return out
        return out

    def reached(self, d: np.ndarray, reach: float, k: int) -> np.ndarray:
        """Blocks other than the first ones that may hold a row within ``reach``."""
        own = int(d.argmin())
        between = np.sqrt(((self.pivots - self.pivots[own]) ** 2).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(between > 0, (d ** 2 - d[own] ** 2) / (2 * between), 0.0)
        within = reach * (1 + SLACK) + SLACK
        rings = np.flatnonzero((self.gap(d) <= within) & (plane[self.cell] <= within))
        out = [np.arange(self.first[r], self.first[r] + self.slices[r]) for r in rings]
        every = np.concatenate(out) if out else np.empty(0, np.int64)
        return np.setdiff1d(every, self.first[self.home(d, k)])


def assigned(train: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``train`` (t_id, t_label, v) with its cell and the distance to its pivot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = distances(matrix(b.column("v")), pivots)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(
                    d[np.arange(len(cell)), cell])], [*b.schema.names, "cell", "dist"])

    kind = train.schema["v"].dataType.simpleString()
    return train.mapInArrow(run, f"t_id long, t_label int, v {kind}, cell int, dist double")


def in_blocks(rows: DataFrame, block: int, pivots: np.ndarray) -> tuple[DataFrame, Cells]:
    """``rows`` (staged, with cell and dist) with their block number, and the cells."""
    stats = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("d0"), F.max("dist").alias("d1"))
    cut = F.ceil(F.col("n") / block)
    ring = F.least(cut - 1, F.floor((F.col("dist") - F.col("d0")) / F.nullif(F.col("d1") - F.col("d0"), F.lit(0.0)) * cut))
    ringed = rows.join(F.broadcast(stats), "cell").withColumn("ring", F.coalesce(ring, F.lit(0)).cast("int"))
    table = ringed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("rows"), F.min("dist").alias("low"),
                                               F.max("dist").alias("high")).toPandas().sort_values(["cell", "ring"])
    table["slices"] = -(-table["rows"] // block)
    table["first"] = table["slices"].cumsum() - table["slices"]
    cells = Cells(pivots, *(table[c].to_numpy() for c in ("cell", "rows", "low", "high", "slices", "first")))
    small = rows.sparkSession.createDataFrame(table[["cell", "ring", "slices", "first"]].astype("int64"))
    placed = ringed.join(F.broadcast(small), ["cell", "ring"])
    number = F.col("first") + F.pmod(F.xxhash64("t_id"), F.col("slices"))
    return placed.select("t_id", "t_label", "v", "dist", "cell", number.alias("block")), cells


def sent(queries: DataFrame, cells: Cells, k: int, first: bool) -> DataFrame:
    """(q_id, v, reach, block) for the blocks a query row (q_id, v, reach) meets
    first, or those it reaches after that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                d = distances(matrix(b.column("v")), cells.pivots)
                reach = b.column("reach").to_numpy(zero_copy_only=False)
                blocks = [cells.first[cells.home(x, k)] if first else cells.reached(x, r, k)
                          for x, r in zip(d, reach, strict=True)]
                rows = np.repeat(np.arange(len(blocks)), [len(x) for x in blocks])
                got = b.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*got.columns, pa.array(
                    np.concatenate(blocks).astype(np.int64) if blocks else np.empty(0, np.int64))],
                    [*b.schema.names, "block"])

    kind = queries.schema["v"].dataType.simpleString()
    return queries.select("q_id", "v", "reach").mapInArrow(run, f"q_id long, v {kind}, reach double, block long")


def measured(pairs: DataFrame, blocks: DataFrame, cells: Cells, k: int, count: bool = False) -> DataFrame:
    """The best k rows of each block for each query row sent to it, as (q_id,
    t_id, t_label, d2); with ``count`` the pairs measured, as (measured)."""
    pivots = cells.pivots

    def run(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return empty.copy()
        t = t.sort_values("dist")
        qm, tm = np.stack(q["v"].to_numpy()).astype(np.float64), np.stack(t["v"].to_numpy()).astype(np.float64)
        dist, tid, label = t["dist"].to_numpy(), t["t_id"].to_numpy(), t["t_label"].to_numpy()
        at = np.sqrt(((qm - pivots[int(t["cell"].iloc[0])]) ** 2).sum(axis=1))
        within = q["reach"].to_numpy() * (1 + SLACK) + SLACK
        lo, hi = np.searchsorted(dist, at - within), np.searchsorted(dist, at + within, side="right")
        if count:
            return pd.DataFrame({"measured": [int((hi - lo).sum())]})
        out, qid = [], q["q_id"].to_numpy()
        # rows with about the same window are measured together; the window may only grow
        order = np.argsort(lo, kind="stable")
        for s in range(0, len(order), 256):
            some = order[s:s + 256]
            a, b = int(lo[some].min()), int(hi[some].max())
            if b > a:
                d, near = nearest_rows(qm[some], tm[a:b], tid[a:b], k)
                flat = near.reshape(-1) + a
                out.append(pd.DataFrame({"q_id": np.repeat(qid[some], near.shape[1]), "t_id": tid[flat],
                                         "t_label": label[flat], "d2": d.reshape(-1)}))
        return pd.concat(out) if out else empty.copy()

    load = pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PER_COPY).cast("long").alias("copies"))
    load = F.broadcast(load.where("copies > 1"))  # at most one line a block
    copies = F.coalesce("copies", F.lit(1).cast("long"))
    left = pairs.join(load, "block", "left").withColumn("copy", F.pmod(F.xxhash64("q_id"), copies)).drop("copies")
    right = blocks.join(load, "block", "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    schema = "measured long" if count else "q_id long, t_id long, t_label int, d2 double"
    empty = pd.DataFrame({"measured": pd.Series([], dtype="int64")}) if count else pd.DataFrame(
        {"q_id": pd.Series([], dtype="int64"), "t_id": pd.Series([], dtype="int64"),
         "t_label": pd.Series([], dtype="int32"), "d2": pd.Series([], dtype="float64")})
    return left.groupBy("block", "copy").cogroup(right.drop("copies").groupBy("block", "copy")).applyInPandas(run, schema)


def best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q_id").orderBy("d2", "t_id")
    return found.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)


def knn_pivots(train: DataFrame, query: DataFrame, k: int = 7, id_col: str = "vec_id", vec_col: str = "embedding",
               label_col: str = "label", block: int = BLOCK, count: bool = False) -> DataFrame:
    """Exact k nearest training rows (euclidean, ties by id) per query row:
    (q_id, t_id, t_label, d2, nn_rank). With ``count``, one row: the pairs
    measured and all ``pairs`` there are. Query ids are unique."""
    if k <= 0:
        raise ValueError("k must be > 0")
    t = train.select(F.col(id_col).cast("long").alias("t_id"), F.col(label_col).cast("int").alias("t_label"),
                     F.col(vec_col).alias("v"))
    q = query.select(F.col(id_col).cast("long").alias("q_id"), F.col(vec_col).alias("v"))
    n_t, n_q = t.count(), q.count()
    if n_t <= 2 * block and not count:  # one or two blocks: nothing to choose from
        return knn_neighbours(train, query, k, id_col, vec_col, label_col)
    block = max(block, n_t // MAX_BLOCKS)
    every = max(1, n_t // SAMPLE)
    sample = t.where(F.pmod(F.xxhash64("t_id", F.lit(1)), F.lit(every)) == 0).select("v").toArrow().column("v")
    pivots = choose_pivots(matrix(sample), min(MAX_PIVOTS, max(1, int(n_t ** 0.5)), len(sample)))
    blocks, cells = in_blocks(materialize(assigned(t, pivots), "knn-cells"), block, pivots)
    blocks = materialize(blocks, "knn-blocks")

    anywhere = q.withColumn("reach", F.lit(float("inf")))
    opening = sent(anywhere, cells, k, first=True)
    near = materialize(measured(opening, blocks, cells, k), "knn-near")
    kth = near.groupBy("q_id").agg(F.array_sort(F.collect_list("d2")).alias("d")).select(
        "q_id", F.sqrt(F.get("d", F.lit(k - 1))).alias("reach"))
    q = materialize(q.join(kth, "q_id", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf")))), "knn-reach")
    if count:
        counts = [measured(p, blocks, cells, k, count=True) for p in (opening, sent(q, cells, k, first=False))]
        return counts[0].unionByName(counts[1]).agg(F.sum("measured").alias("measured"), F.lit(n_t * n_q).alias("pairs"))
    some = q.where(F.pmod(F.xxhash64("q_id", F.lit(2)), F.lit(max(1, n_q // PLAN_SAMPLE))) == 0)
    reach = sent(some, cells, k, first=False).count() / max(1, some.count())
    if reach * n_q > n_q * -(-n_t // KNN_TRAIN_CELL) + n_t * -(-n_q // KNN_QUERY_CELL):
        return knn_neighbours(train, query, k, id_col, vec_col, label_col)
    return best(near.unionByName(measured(sent(q, cells, k, first=False), blocks, cells, k)), k)
