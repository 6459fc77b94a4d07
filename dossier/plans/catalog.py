"""Query catalog: one Spark plan per operator binding, each with the DuckDB
SQL that states the same result (the oracle). Keys follow SURVEY §2.13."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its oracle (None = rows-only check)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from dossier.plans import q_profiles, q_entities, q_text, q_parse, q_quality  # noqa: F401
    from dossier.plans import q_io  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)


def sources_text(c: str = "sources") -> F.Column:
    """Ordered source list rendered as one string for result comparison."""
    return F.array_join(F.col(c), "|")


__all__ = ["register", "queries", "oracle_sql", "sources_text"]
