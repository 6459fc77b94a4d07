"""Entity-table operators (P-1..P-4, A-2, L-1..L-3, L-5, J-1, W-4, W-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.functions import text as T
from dossier.functions.states import decode_state
from dossier.operators import ranking as RK
from dossier.operators.joins import checked_broadcast

NAME_PARTS = ("first", "middle", "last", "suffix")
RANGE_GROUP_WIDTH = 9_700
RANGE_GROUP_COUNT = 16
BATCH_SIZE = 100


def normalise(entities: DataFrame) -> DataFrame:
    """Lower-case name parts, the full name (non-null parts joined by one
    space), decoded state, typed year and id, explicit row number."""
    full = F.lower(F.concat_ws(" ", *[F.col(c) for c in NAME_PARTS]))
    return entities.select(
        "row", F.col("candid").cast("string").alias("candid"),
        F.lower("first").alias("first"), F.lower("middle").alias("middle"),
        F.lower("last").alias("last"), full.alias("full"),
        F.col("min_year").cast("int").alias("min_year"),
        decode_state("sab").alias("state"),
    )


def sample_key(seed: int, key: str = "candid") -> F.Column:
    """Repeatable per-row random key: md5 of seed and id (same in any engine)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_distinct(entities: DataFrame, n: int, seed: int = 0, by: str = "full") -> DataFrame:
    """n rows chosen at random, unique by ``by`` (the full name by default,
    or ``candid``). Each name keeps its row with the smallest random key, so
    a name with many rows is more likely to be drawn, as in the reference's
    rejection sampling; returns min(n, distinct names) rows and always ends.
    The per-name pick is a partial (map-side) aggregate; the first n keys
    come from range-partitioned positions (``ranking.ordered_index``), so no
    task holds more than a range whatever n is."""
    if n <= 0:
        raise ValueError("n must be > 0")
    k = sample_key(seed)
    picked = (entities.withColumn("_k", k)
              .groupBy(by).agg(F.min_by(F.struct(*[c for c in entities.columns if c != by]), "_k").alias("_r"),
                               F.min("_k").alias("_k")))
    first = RK.ordered_index(picked, ["_k", by], name="_i").filter(F.col("_i") < n).drop("_i")
    return first.select(by, "_r.*", "_k").drop("_k")


def first_n(entities: DataFrame, n: int) -> DataFrame:
    """First n rows in file order (row < n; pushes down to the scan)."""
    if n <= 0:
        raise ValueError("n must be > 0")
    return entities.filter(F.col("row") < n)


def select_rows(spark: SparkSession, entities: DataFrame, rows: Sequence[int]) -> DataFrame:
    """Rows looked up by row number; list order and duplicates are kept in
    ``pos``. Row numbers that do not exist yield nothing."""
    wanted = spark.createDataFrame([(i, int(r)) for i, r in enumerate(rows)], "pos int, row bigint")
    return entities.join(checked_broadcast(wanted), "row").orderBy("pos")


def range_group(row_col: str = "row", width: int = RANGE_GROUP_WIDTH,
                groups: int = RANGE_GROUP_COUNT) -> F.Column:
    """Label of the fixed-width row range; the last range is open-ended
    ("lo-end")."""
    if width <= 0 or groups <= 0:
        raise ValueError("width and groups must be > 0")
    g = F.least(F.floor(F.col(row_col) / width), F.lit(groups - 1)).cast("bigint")
    lo = g * width
    return F.when(g == groups - 1, F.concat(lo.cast("string"), F.lit("-end"))) \
        .otherwise(F.concat(lo.cast("string"), F.lit("-"), (lo + width - 1).cast("string")))


def completeness(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Adds ``status`` ('ok' or 'incomplete') and ``missing``, the required
    columns that are null, comma-joined; an absent column is an error."""
    absent = [c for c in required if c not in df.columns]
    if absent or not required:
        raise ValueError(f"required columns that the table lacks: {absent}" if absent else "no required columns")
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return df.withColumn("missing", missing).withColumn(
        "status", F.when(F.col("missing") == "", "ok").otherwise("incomplete"))


def split_complete(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rejects with what they miss)."""
    checked = completeness(df, required)
    return (checked.filter("status = 'ok'").select(*df.columns),
            checked.filter("status <> 'ok'").select(*df.columns, "missing"))


def batch_number(row_col: str = "row", size: int = BATCH_SIZE) -> F.Column:
    if size <= 0:
        raise ValueError("size must be > 0")
    return F.floor(F.col(row_col) / size).cast("bigint")


def batch_range(df: DataFrame, first_batch: int = 0, last_batch: int | None = None,
                size: int = BATCH_SIZE) -> DataFrame:
    """Rows of batches first_batch <= batch < last_batch (None = no end)."""
    b = batch_number(size=size)
    out = df.withColumn("batch", b).filter(F.col("batch") >= first_batch)
    return out if last_batch is None else out.filter(F.col("batch") < last_batch)


def title(c) -> F.Column:
    return T.title_case(c)
