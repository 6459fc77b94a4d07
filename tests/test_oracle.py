"""Spark result == DuckDB oracle on the smallest tables, for a spread of
queries (the full sweep is scripts/oracle_check.py at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from dossier.sources.tables import TABLES
from scripts.oracle_check import digest

NAMES = ["profile_sample", "sample_distinct", "select_rows", "range_groups", "html_to_text", "link_bm25",
         "keyword_excerpt", "parse_json", "enrich_stub", "route_failures", "encode_categories",
         "eval_fold_f1", "holdout_split", "knn_classify", "union_shards", "scan_prompts"]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert digest(rows, df.columns)[0] == digest(res.fetchall(), res.columns)[0]
