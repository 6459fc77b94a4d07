"""Operator edge rows and invariants (FIXTURES §D, SURVEY §5)."""

import pytest
from pyspark.sql import functions as F

from dossier.operators import enrich as EN
from dossier.operators import entities as E
from dossier.operators import quality as Q
from dossier.operators import ranking as RK
from dossier.operators import rerun as R
from flaky import FlakyService
from dossier.plans import views as V
from dossier.session import scratch_path
from dossier.sources import csv as C


def test_first_n_and_sample_larger_than_table(spark, sf):
    ents = E.normalise(V.entities(spark, sf))
    n = ents.count()
    assert E.first_n(ents, n + 100).count() == n
    names = ents.select("full").distinct().count()
    s = E.sample_distinct(ents, n + 100, seed=1)
    assert s.count() == names and s.select("full").distinct().count() == names


def test_select_rows_keeps_order_and_duplicates(spark, sf):
    ents = E.normalise(V.entities(spark, sf))
    got = [r.row for r in E.select_rows(spark, ents, [5, 0, 5]).collect()]
    assert got == [5, 0, 5]


def test_parameter_guards():
    with pytest.raises(ValueError):
        EN.Policy(tries=0)
    with pytest.raises(ValueError):
        E.range_group(width=0)
    from dossier.operators.link import check_r
    with pytest.raises(ValueError):
        check_r(5)


def test_category_codes(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["b", None, "a", "B", "é"])], "i int, v string")
    got = {r.i: r.v_code for r in RK.dense_codes_many(df, ["v"]).collect()}
    assert [got[i] for i in range(5)] == [2, -1, 1, 0, 3]


def test_folds_are_stratified_and_balanced(spark):
    df = spark.range(103).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    f = RK.stratified_folds(df, "y", "id", k=5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in f if r.y == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_report_never_predicted_class(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "y int, p int")
    rep = {r.label: r for r in Q.report(df).collect()}
    assert rep[1].precision == 0.0 and rep[1].f1 == 0.0 and rep[1].support == 2
    conf = {(r.y, r.p): r.n for r in Q.confusion(df).collect()}
    assert conf == {(0, 0): 1, (0, 1): 0, (1, 0): 2, (1, 1): 0}


def test_metrics_keep_every_class(spark):
    df = spark.createDataFrame([(1, 0), (2, 2), (3, 1), (None, 1)], "y int, p int")
    conf = {(r.y, r.p): r.n for r in Q.confusion(df).collect()}
    assert len(conf) == 16 and conf[2, 2] == conf[3, 1] == conf[1, 0] == 1 and sum(conf.values()) == 3
    rep = {r.label: r for r in Q.report(df).collect()}
    assert sorted(rep) == [0, 1, 2, 3] and rep[2].f1 == 1.0 and rep[3].support == 1
    avg = {r.average: r for r in Q.report_averages(df).collect()}
    assert avg["macro avg"].f1 == 0.25 and avg["weighted avg"].recall == round(1 / 3, 6)


def test_knn_measures_close_vectors_exactly(spark):
    base = [1000.0] * 8
    rows = [(i, [*base[:-1], 1000.0 + (40 - i) * 1e-5], 0) for i in range(40)]
    train = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    query = spark.createDataFrame([(99, base, 0)], "vec_id long, embedding array<double>, label int")
    got = Q.knn_neighbours(train, query, k=3).orderBy("nn_rank").collect()
    assert [r.t_id for r in got] == [39, 38, 37] and abs(got[0].d2 - 1e-10) < 1e-15


def test_union_shards_by_name(spark):
    base = scratch_path(spark, "t-shards")
    a = spark.createDataFrame([("1", "x")], "a string, b string")
    C.write_csv(a, f"{base}/s0")
    C.write_csv(a.select("b", "a"), f"{base}/s1")
    C.write_csv(a.select("a"), f"{base}/s2")
    from pyspark.sql import types as TY
    sch = TY.StructType([TY.StructField("a", TY.StringType()), TY.StructField("b", TY.StringType())])
    rows = sorted((tuple(r) for r in C.union_shards(spark, C.list_shards(spark, base), sch).collect()),
                  key=lambda t: tuple("" if v is None else v for v in t))
    assert rows == [("1", None), ("1", "x"), ("1", "x")]


def test_csv_roundtrip_tricky_field(spark):
    val = 'q"uote, comma\nnew line / slash \\ back  '
    df = spark.createDataFrame([(1, val), (2, ""), (3, None)], "i int, s string")
    p = scratch_path(spark, "t-csv")
    C.write_csv(df, p)
    back = {r.i: r.s for r in C.read_csv(spark, p, df.schema).collect()}
    assert back == {1: val, 2: "", 3: None}


def test_latin1_entity_read(spark):
    p = scratch_path(spark, "t-latin1")
    df = spark.createDataFrame([(0, "José", None, "Núñez", None, 1990, " al ", "7")], C.ENTITY_SOURCE_SCHEMA)
    C.write_csv(df, p, encoding="ISO-8859-1")
    r = C.read_entity_csv(spark, p).first()
    assert (r.first, r.last, r.sab, r.middle) == ("José", "Núñez", " al ", None)


def test_enrich_retry_and_routing(spark):
    df = spark.createDataFrame([(str(k), f"p{k}") for k in (1, 2, 3, 7, 14)], "candid string, prompt string")
    pol = EN.Policy(tries=3, timeout=None, token_limit=None, **EN.NO_WAIT)
    out = {r.candid: r for r in EN.enrich(df, FlakyService(sleep=0.0), "prompt", "candid", pol).collect()}
    assert (out["3"].status, out["3"].attempts) == ("ok", 2)      # fails once
    assert (out["7"].status, out["7"].attempts) == ("error", 3)   # always fails
    assert out["2"].attempts == 1 and out["7"].reason.startswith("RuntimeError")


def test_enrich_timeout_and_budget(spark):
    df = spark.createDataFrame([("51", "x"), ("2", "y" * 100)], "candid string, prompt string")
    pol = EN.Policy(tries=3, timeout=0.2, token_limit=10, **EN.NO_WAIT)
    out = {r.candid: r.status for r in EN.enrich(df, FlakyService(sleep=1.0), "prompt", "candid", pol).collect()}
    assert out == {"51": "timeout", "2": "prompt"}


def test_every_entity_is_result_or_dead_letter(spark, sf):
    from dossier.plans.q_parse import route_run
    run = route_run(spark, sf)
    results, dead = R.split_outcomes(run)
    n = run.count()
    assert results.count() + dead.count() == n
    assert results.select("candid").intersect(dead.select("candid")).count() == 0


def test_rerun_is_idempotent(spark):
    p = scratch_path(spark, "t-append")
    a = spark.createDataFrame([("1", "error"), ("2", "ok")], "candid string, status string")
    R.append_attempt(a, p, 1)
    R.append_attempt(a.filter("candid = '1'").withColumn("status", F.lit("ok")), p, 2)
    R.append_attempt(a.filter("candid = '1'").withColumn("status", F.lit("ok")), p, 2)
    got = {(r.candid, r.attempt, r.status) for r in R.latest_attempt(spark.read.parquet(p)).collect()}
    assert got == {("1", 2, "ok"), ("2", 1, "ok")}


@pytest.mark.parametrize("cells", [None, (3, 7, 1)])
def test_knn_matches_brute_force(spark, monkeypatch, cells):
    """Default cells (one block) and tiny cells (many query blocks x many
    training buckets) both give the exact neighbours."""
    import numpy as np
    if cells:
        for name, v in zip(("KNN_QUERY_CELL", "KNN_TRAIN_CELL", "KNN_MIN_TRAIN_CELL", "KNN_SLICE"), (*cells, 2)):
            monkeypatch.setattr(Q, name, v)
    rng = np.random.default_rng(0)
    vecs = rng.normal(size=(60, 8)).astype(np.float32)
    rows = [(i, [float(x) for x in vecs[i]], int(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    train, test = df.filter("vec_id % 5 <> 0"), df.filter("vec_id % 5 = 0")
    got = {r.q_id: sorted(r.ids) for r in Q.knn_neighbours(train, test, k=4)
           .groupBy("q_id").agg(F.collect_list("t_id").alias("ids")).collect()}
    v64 = vecs.astype(np.float64)
    tr = [i for i in range(60) if i % 5]
    assert sorted(got) == list(range(0, 60, 5))
    for q in range(0, 60, 5):
        d = sorted(((((v64[q] - v64[t]) ** 2).sum(), t) for t in tr))[:4]
        assert got[q] == sorted(t for _, t in d)


def test_rate_limit_spaces_calls_within_a_task(spark):
    import time as _t
    df = spark.createDataFrame([(str(i), "p") for i in range(10)], "candid string, prompt string").coalesce(1)
    pol = EN.Policy(tries=1, timeout=None, token_limit=None, rate=20.0, **EN.NO_WAIT)
    def stamp(prompt):
        return str(_t.monotonic())

    out = sorted(float(r.response) for r in EN.enrich(df, stamp, "prompt", policy=pol).collect())
    gaps = [b - a for a, b in zip(out, out[1:])]
    assert min(gaps) >= 0.045


def test_sample_is_the_top_n(spark, sf):
    """The rows from ordered positions are those of one global sort."""
    ents = E.normalise(V.entities(spark, sf))
    sample = sorted(r.full for r in E.sample_distinct(ents, 40, seed=3).collect())
    keys = ents.withColumn("k", E.sample_key(3)).groupBy("full").agg(F.min("k").alias("k"))
    assert sample == sorted(r.full for r in keys.orderBy("k").limit(40).collect())


def test_a_timeout_of_the_service_is_tried_again(spark):
    def service(prompt, left=[2]):
        if prompt == "always" or left[0]:
            left[0] -= prompt != "always"
            raise TimeoutError("x" * 600)
        return "done"

    df = spark.createDataFrame([("a", "twice"), ("b", "always")], "candid string, prompt string").coalesce(1)
    for timeout in (None, 5.0):
        pol = EN.Policy(tries=3, timeout=timeout, token_limit=None, **EN.NO_WAIT)
        out = {r.candid: r for r in EN.enrich(df, service, "prompt", policy=pol).collect()}
        assert (out["a"].status, out["a"].attempts) == ("ok", 3)
        assert (out["b"].status, out["b"].attempts) == ("timeout", 3)
        assert out["b"].reason == "TimeoutError: " + "x" * 600


def test_include_and_completeness_guard_their_arguments(spark):
    df = spark.createDataFrame([("1", None, 1990), ("2", "x", 2000)], "candid string, a string, min_year int")
    assert [r.candid for r in Q.include(df, "output", ["a"]).collect()] == ["2"]
    assert Q.include(df, "all", ["a"]).count() == 2 and Q.include(df, "years", ["a"]).count() == 1
    with pytest.raises(ValueError):
        Q.include(df, "some", ["a"])
    ok, rejects = E.split_complete(df, ["candid", "a"])
    assert [r.candid for r in ok.collect()] == ["2"] and [(r.candid, r.missing) for r in rejects.collect()] == [("1", "a")]
    for bad in ([], ["nope"]):
        with pytest.raises(ValueError):
            E.completeness(df, bad)
