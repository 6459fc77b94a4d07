"""What the operators share: row numbers, folds, staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.session import materialize

#: The ASCII white space that ends a word, and words as runs of
#: anything else. ``bytes.split()`` in Python splits at exactly these bytes.
SPACES = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder, compressed with zstandard, and read back."""
    return materialize(df, name, compression="zstd")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column of ``df`` has it
    (in any case: Spark's names ignore it)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` staged with a row number, and the number's column. Staging
    pins the number to the row whatever is recomputed later."""
    rid = fresh(docs, "rid")
    return stage(docs.withColumn(rid, F.monotonically_increasing_id()), name), rid


def fold(col: str | Column, of: int) -> Column:
    """crc32 of the value as text, modulo ``of``; null for a null value."""
    return F.crc32(F.col(col).cast("string") if isinstance(col, str) else col.cast("string")) % of


def count_over(spark: SparkSession, df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has more than ``limit`` rows, read no further than that."""
    return df.limit(limit + 1).count() > limit


#: DuckDB has no crc32: its table of 256 steps (``steps.t``), as common tables of
#: a WITH RECURSIVE. Fixed value: the polynomial of zlib's crc32.
CRC_SQL = """crc(b, c, k) AS (
  SELECT i::UBIGINT, i::UBIGINT, 0 FROM range(256) r(i)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8),
steps AS (SELECT list(c ORDER BY b) AS t FROM crc WHERE k = 8)"""


def crc32_sql(expr: str) -> str:
    """DuckDB SQL for crc32 of an ASCII string, beside ``steps``."""
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({expr}, ''), "
            "lambda x: ascii(x)::UBIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT)")
