"""The queries op1 to op13 and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dossier.llm import (brown, conversation, decontaminate, langid, licenses, linededup, merkle, packing, pieces,
                         quality, rules, simhash, warc)

MODULES = (linededup, packing, warc, brown, rules, decontaminate, quality, simhash, langid, licenses, pieces, merkle,
           conversation)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
