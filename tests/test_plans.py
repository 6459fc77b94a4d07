"""Plan checks: no cartesian products, Python only where it is the
operator, filters and pruning reach the Parquet scan."""

import pytest

import __spark_entry__ as E

PYTHON_OK = {"enrich_stub", "enrich_retry", "route_failures", "missing_entities", "loss_funnel",
             "stage_counts", "rerun_offset", "rerun_timeouts", "rerun_append", "rerun_prompt_errors",
             "knn_classify", "profile_rows", "profile_rerun", "eval_validation"}
CHEAP = ["normalise_entities", "decode_state", "link_top_r", "link_bm25", "contains_cascade",
         "parse_json", "labelled_all", "eval_report", "profile_sample", "first_k_segments",
         "coverage_by_year", "stratified_folds"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHEAP)
def test_no_cartesian_and_no_python(spark, sf, name):
    p = plan(E.queries()[name](spark, sf))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    if name not in PYTHON_OK:
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p and "MapInPandas" not in p


def test_first_n_pushes_filter_and_prunes(spark, sf):
    p = plan(E.queries()["first_n"](spark, sf))
    assert "PushedFilters: [IsNotNull(c_custkey), LessThan(c_custkey,50)" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_mktsegment:string>" in p


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["candid", "full", "state", "min_year", "sources", "context",
                                             "prompt"]


def test_queue_offset_has_no_single_task_limit(spark, sf):
    p = plan(E.queries()["rerun_offset"](spark, sf))
    assert "CollectLimit" not in p and "GlobalLimit" not in p


def test_link_top_r_limits_every_window_map_side(spark, sf):
    """Both the per-subset and the per-entity top r run a partial group
    limit before their exchange; no (entity, document) pair per term."""
    p = plan(E.queries()["link_top_r"](spark, sf))
    assert p.count("WindowGroupLimit") >= 3 and "Partial" in p


def test_knn_never_collects_to_the_driver(spark, sf, monkeypatch):
    from pyspark.sql import DataFrame
    def refuse(self, *a, **k):
        raise AssertionError("collect() on the driver")
    monkeypatch.setattr(DataFrame, "collect", refuse)
    monkeypatch.setattr(DataFrame, "toPandas", refuse)
    df = E.queries()["knn_classify"](spark, sf)
    assert "FlatMapCoGroupsInPandas" in plan(df)
