"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row bound under which a join side may be shipped to every executor.
DEFAULT_BROADCAST_ROWS = 2_000_000


def bounded_count(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> int:
    """Row count of ``df``, counting at most max_rows + 1 rows."""
    return df.limit(max_rows + 1).count()


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (counts at most
    max_rows + 1 of them)."""
    return bounded_count(df, max_rows) <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after counting it: under ``max_rows`` it gets the
    broadcast hint, above it the plain DataFrame is returned and the join
    falls back to a shuffle join (AQE may still convert it at run time and
    split skewed partitions). Only call this on sides that are cheap to count
    (dimension tables, entity lists, link tables)."""
    return F.broadcast(df) if fits(df, max_rows) else df


def hint_if(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast hint for a side whose bound was already proven."""
    return F.broadcast(df) if small else df
