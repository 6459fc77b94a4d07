"""Exact global row positions without a single-task window (W-2, W-3, L-6).

``Window.orderBy(...)`` with no partition pulls every row into one task,
and a window partitioned by a low-cardinality key (a class label) puts a
whole class into one task. Instead: range-partition on the ordering keys,
number rows inside each partition, count rows per (partition, group),
turn the counts into offsets with a window over that small table, and add
the offsets back with a broadcast join. Every step is parallel; the only
small table has (partitions x groups) rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators.joins import checked_broadcast
from dossier.session import materialize


def ordered_index(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
                  name: str = "idx", partitions: int | None = None) -> DataFrame:
    """Adds ``name``: the 0-based position of each row within its ``by``
    group in ``order`` (ascending). ``order`` must be a total order (end it
    with a unique key). ``by`` should have few distinct values."""
    spark = df.sparkSession
    # the session's shuffle partitions are set for its data
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*by, *order]
    pid = F.spark_partition_id()
    # the input runs once: sampling the ranges and dealing them read this copy
    df = materialize(df, "unordered")
    # positions are fixed by writing the range-partitioned, sorted rows once
    x = materialize(
        df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        .withColumn("_pid", pid)
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)),
        "ordered")
    counts = x.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_c"), F.min("_pos").alias("_start"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    return (x.join(checked_broadcast(offs.select("_pid", *by, "_off", "_start"), 1_000_000), ["_pid", *by])
            .withColumn(name, (F.col("_off") + F.col("_pos") - F.col("_start")).cast("bigint"))
            .drop("_pid", "_pos", "_off", "_start"))


def fit_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fitted code table (_col, _v, _code) for several string columns in one pass:
    the distinct (column, value) pairs of all columns are numbered
    together, grouped by column (code-point order, 0..k-1)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("string").alias("_v"))
                                for c in columns])).alias("_p")
    stacked = df.select(pairs).select("_p._col", "_p._v").where(F.col("_v").isNotNull())
    # the fitted code table is written once and read by every column's join
    return materialize(ordered_index(stacked.distinct(), ["_v"], by=["_col"], name="_code"), "codes")


#: A column's codes are broadcast up to this size, values and some 16 bytes a code.
BROADCAST_BYTES = 1 << 20


def apply_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Join each column's codes back on the value; null and values the code
    table has not seen get -1. A column's codes (one row per distinct value)
    are broadcast where they are few and short, the usual case for categories,
    so the wide table is not shuffled for it; others are joined by sorting both
    sides, whatever the planner takes for small, so nothing that grows with the
    rows passes through the driver."""
    sizes = {r._col: r.size for r in codes.groupBy("_col").agg(F.sum(F.octet_length("_v") + 16).alias("size")).collect()}
    out = df
    for c in columns:
        mine = codes.filter(F.col("_col") == c).select(F.col("_v").alias(f"_v_{c}"), "_code")
        mine = F.broadcast(mine) if sizes.get(c, 0) <= BROADCAST_BYTES else mine.hint("merge")
        out = (out.join(mine, out[c] == mine[f"_v_{c}"], "left")
               .withColumn(f"{c}{suffix}", F.coalesce(F.col("_code"), F.lit(-1)).cast("int"))
               .drop("_code", f"_v_{c}"))
    return out


def ranked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the values of string columns replaced by short strings in the same
    order: ranks among the distinct values, padded with zeros; null stays null. Codes
    fitted on any of these rows are the same as on the values."""
    coded = dense_codes_many(df, columns, "_rank")
    names = [F.when(F.col(f"{c}_rank") >= 0, F.lpad(F.col(f"{c}_rank").cast("string"), 10, "0")).alias(c)
             if c in columns else F.col(c) for c in df.columns]
    return coded.select(*names)


def dense_codes_many(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Category codes of several string columns, fitted on ``df`` itself:
    distinct non-null values in code-point order get 0..k-1, null gets -1."""
    if not columns:
        return df
    return apply_codes(df, fit_codes(df, columns), columns, suffix)


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 0,
                     name: str = "fold") -> DataFrame:
    """Shuffled stratified k folds: within each class, rows in md5(seed,key)
    order are dealt round-robin to folds 0..k-1 (fold sizes differ by <= 1)."""
    if k < 2:
        raise ValueError("k must be >= 2")
    h = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    r = ordered_index(h, ["_h", key], by=[label], name="_r")
    return r.withColumn(name, (F.col("_r") % k).cast("int")).drop("_h", "_r")


def holdout_split(df: DataFrame, key: str, test_fraction: float = 0.15, seed: int = 0,
                  name: str = "part") -> DataFrame:
    """Exact, repeatable split: the first ceil(test_fraction * n) rows in
    md5(seed,key) order are 'test', the rest 'train'."""
    if not 0 < test_fraction < 1:
        raise ValueError("test_fraction must be in (0, 1)")
    h = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    r = ordered_index(h, ["_h", key], name="_r")
    n = r.count()  # one scalar over the written table
    cut = math.ceil(round(test_fraction * n, 9))
    return r.withColumn(name, F.when(F.col("_r") < cut, "test").otherwise("train")).drop("_h", "_r")
