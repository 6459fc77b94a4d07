"""The table of attempts: latest per key, replays change nothing."""

import pytest

from dossier.operators import enrich as EN
from dossier.operators import rerun as R
from dossier.session import materialize
from dossier.sources import attempts as A

SCHEMA = "candid string, status string"


def rows(df):
    return sorted((r.candid, r.attempt, r.status) for r in df.collect())


def test_latest_attempt_by_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(f"k{i}", "error" if i % 3 else "ok") for i in range(50)] + [("k1", "error")], SCHEMA)
    second = spark.createDataFrame([("k1", "ok"), ("k2", "error"), ("new", "ok")], SCHEMA)
    A.upsert(first, path, 1, buckets=8)
    before = A.manifest(spark, path)["folders"]
    A.upsert(second, path, 2)
    after = A.manifest(spark, path)["folders"]
    assert 0 < sum(before.get(b) != f for b, f in after.items()) <= 3  # only the buckets with new rows
    want = sorted([(f"k{i}", 1, "error" if i % 3 else "ok") for i in range(50) if i not in (1, 2)]
                  + [("k1", 2, "ok"), ("k2", 2, "error"), ("new", 2, "ok")])
    assert rows(A.read(spark, path)) == want
    A.upsert(second, path, 2)          # the same attempt again
    A.upsert(first, path, 1)           # an attempt that a later one has overtaken
    assert rows(A.read(spark, path)) == want
    assert A.vacuum(spark, path) > 0 and rows(A.read(spark, path)) == want
    p = A.read(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in p and "Exchange" not in p


def test_empty_and_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        A.read(spark, path)
    A.upsert(spark.createDataFrame([], SCHEMA), path, 1)
    assert A.read(spark, path).collect() == []
    A.upsert(spark.createDataFrame([(None, "ok"), ("a", None)], SCHEMA), path, 2)
    assert {(r.candid, r.status) for r in A.read(spark, path).collect()} == {(None, "ok"), ("a", None)}


def test_two_writers_cannot_both_publish(spark, tmp_path):
    path = str(tmp_path / "t")
    A.upsert(spark.createDataFrame([("a", "ok")], SCHEMA), path, 1)
    now = A.manifest(spark, path)
    with pytest.raises(Exception):
        A._publish(spark, path, now)


def test_counts_come_with_the_write(spark):
    df = spark.createDataFrame([("a", "ok", '{"College Major": "x"}'), ("b", "ok", "text"), ("c", "error", None),
                                ("d", "timeout", None), ("e", "prompt", None), ("f", "ok", None)],
                               "candid string, status string, response string")
    seen_df, seen = R.outcome_counts(df)
    materialize(seen_df)
    assert seen.get == {"entities": 6, "final": 1, "prompt": 1, "enrich": 1, "timeout": 1, "parse": 2}
    assert EN.STATUS_OK == "ok"
