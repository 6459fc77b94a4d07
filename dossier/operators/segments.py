"""First-k segments of paged text (re-aimed PDF reader, S-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_SEGMENTS = 3


def first_k_segments(segments: DataFrame, k: int = MAX_SEGMENTS, key: str = "doc_id",
                     seg: str = "seg_no", text: str = "text") -> DataFrame:
    """Text of the first k segments of each document, joined by one space in
    segment order. Rows beyond k are filtered before the shuffle, so every
    group holds at most k rows."""
    if k <= 0:
        raise ValueError("k must be > 0")
    ordered = F.array_sort(F.collect_list(F.struct(F.col(seg).alias("s"), F.col(text).alias("t"))))
    return (segments.filter(F.col(seg) < k)
            .groupBy(key)
            .agg(F.array_join(F.transform(ordered, lambda x: x["t"]), " ").alias("text"),
                 F.size(ordered).alias("segments")))
