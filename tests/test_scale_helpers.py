"""Exactness of the scale helpers against plain-Python brute force."""

import math
import random

import pytest
from collections import Counter


from pyspark.sql import functions as F

from dossier.functions import text as T
from dossier.operators import enrich as EN
from dossier.operators import link as L
from dossier.operators import ranking as RK
from dossier.operators import rerun as R
from dossier.operators.corpus import Corpus
from dossier.sources.tables import spread


def test_ordered_index_matches_sort(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("abc"), rng.randrange(50)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, v int").repartition(7)
    got = {r.id: r.idx for r in RK.ordered_index(df, ["v", "id"], by=["g"], partitions=5).collect()}
    for g in "abc":
        order = sorted((v, i) for i, gg, v in rows if gg == g)
        assert [got[i] for _, i in order] == list(range(len(order)))


def test_holdout_is_exact(spark):
    df = spark.range(101).withColumnRenamed("id", "k")
    parts = Counter(r.part for r in RK.holdout_split(df, "k", 0.15).collect())
    assert parts["test"] == math.ceil(0.15 * 101) and parts["train"] == 101 - 16


def test_first_words(spark):
    df = spark.createDataFrame([("--Hello, big  world! more",), ("one",), ("",), ("123 ä-b",)], "s string")
    got = [tuple(r) for r in df.select(*T.first_words("s", 3)).collect()]
    assert got == [("Hello", "big", "world"), ("one", None, None), (None, None, None), ("ä", "b", None)]


def test_spread_only_widens_narrow_scans(spark):
    one = spark.range(10).coalesce(1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert spread(many, 4).rdd.getNumPartitions() == 6


def test_corpus_text_after_join(spark):
    raw = spark.createDataFrame([(1, "u1", "<p>Hi Bob</p>"), (2, "u2", "<b>x</b>")], "page_id long, url string, html string")
    c = Corpus(raw, T.html_to_text("html"))
    pairs = spark.createDataFrame([("e", 1, "u1", 1)], "candid string, page_id long, url string, rank int")
    assert [tuple(r) for r in c.text_for(pairs).collect()] == [("e", 1, "u1", 1, "hi bob")]


def bm25_brute(ents, docs, r=2, k1=1.2, b=0.75):
    terms = {p: [w for w in T_re(t)] for p, t in docs.items()}
    n = len(docs)
    avgdl = sum(len(v) for v in terms.values()) / n
    df = Counter(w for v in terms.values() for w in set(v))
    out = {}
    for e, names in ents.items():
        scored = []
        for p, ws in terms.items():
            tf = Counter(ws)
            s, hit = 0.0, False
            for w in set(names):
                if tf[w]:
                    hit = True
                    idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                    s += idf * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(ws) / avgdl))
            if hit:
                scored.append((-round(s, 9), p))
        out[e] = [p for _, p in sorted(scored)[:r]]
    return out


def T_re(t):
    import re
    return re.findall(r"[^\W\d_]+", t)


def test_bm25_matches_brute_force(spark):
    rng = random.Random(5)
    vocab = ["ann", "bo", "cy", "dee", "eli", "fay", "gus", "hal"]
    docs = {i: " ".join(rng.choice(vocab) for _ in range(rng.randrange(3, 30))) for i in range(40)}
    ents = {"e1": ["ann", "bo", "cy"], "e2": ["hal", "gus", "zed"], "e3": ["dee", "dee", "fay"]}
    edf = spark.createDataFrame([(k, *v) for k, v in ents.items()], "candid string, first string, middle string, last string")
    cdf = spark.createDataFrame([(p, f"u{p}", t) for p, t in docs.items()], "page_id long, url string, text string")
    got = {}
    for row in L.link_bm25(edf, cdf, r=2).collect():
        got.setdefault(row.candid, []).append((row.rank, row.page_id))
    want = bm25_brute(ents, docs, r=2)
    assert {e: [p for _, p in sorted(v)] for e, v in got.items()} == want


def test_pending_skips_done_calls(spark):
    prompts = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "candid string, prompt string")
    done = spark.createDataFrame([("1", "a", "ok"), ("2", "old", "ok"), ("3", "c", "error")],
                                 "candid string, prompt string, status string")
    assert sorted(r.candid for r in R.pending(prompts, done).collect()) == ["2", "3"]


def test_codes_fitted_on_train_only(spark):
    train = spark.createDataFrame([("b",), ("a",)], "v string")
    test = spark.createDataFrame([("a",), ("zz",), (None,)], "v string")
    codes = RK.fit_codes(train, ["v"])
    got = [r.v_code for r in RK.apply_codes(test, codes, ["v"]).orderBy(F.col("v").asc_nulls_last()).collect()]
    assert got == [0, -1, -1]


@pytest.mark.parametrize("prune_from", [500_000, 0])
def test_bm25_with_state_matches_brute_force(spark, monkeypatch, prune_from):
    """The state's terms count half, unless a name has them too; ranges of 8
    documents, opened at once or as far as their bounds reach."""
    monkeypatch.setattr(L.PO, "RANGE_BITS", 3)
    rng = random.Random(6)
    vocab = ["ann", "bo", "cy", "dee", "eli", "new", "york", "the", "the", "the"]
    docs = {i: " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 25))) for i in range(120)}
    ents = {f"e{i}": (rng.choice(vocab), rng.choice([None, *vocab]), f"{rng.choice(vocab)}-{rng.choice(vocab)}",
                      rng.choice(["New York", "york", None, "the", "Zed"])) for i in range(40)}
    terms = {p: T_re(t) for p, t in docs.items()}
    n, avgdl = len(terms), sum(map(len, terms.values())) / len(terms)
    df = Counter(w for v in terms.values() for w in set(v))
    want = {}
    for e, (*names, state) in ents.items():
        for p, ws in terms.items():
            tf, factor = Counter(ws), {}
            for part, f in [(state, 0.5), *((x, 1.0) for x in names)]:
                part = T_re((part or "").lower())
                if part and all(tf[w] for w in part):
                    factor |= {w: max(f, factor.get(w, 0)) for w in part}
            if factor:
                s = sum(f * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 /
                        (tf[w] + 1.2 * (0.25 + 0.75 * len(ws) / avgdl)) for w, f in factor.items())
                want.setdefault(e, []).append((-round(s, 9), p))
    edf = spark.createDataFrame([(k, *v) for k, v in ents.items()],
                                "candid string, first string, middle string, last string, state string")
    cdf = spark.createDataFrame([(p, f"u{p}", t) for p, t in docs.items()], "page_id long, url string, text string")
    got = {}
    for row in L.link_bm25(edf, cdf, r=3, state="state", prune_from=prune_from).collect():
        got.setdefault(row.candid, []).append((row.rank, row.page_id))
    assert {e: [p for _, p in sorted(v)] for e, v in got.items()} == {e: [p for _, p in sorted(v)[:3]] for e, v in want.items()}


@pytest.mark.parametrize("r", [1, 4])
@pytest.mark.parametrize("prune_from", [500_000, 0])
def test_overlap_links_match_brute_force_with_hot_terms(spark, monkeypatch, r, prune_from):
    """Many entities share a stop word that most documents contain; scores
    tie often. The subset-candidate ranking must equal the exhaustive one."""
    monkeypatch.setattr(L.PO, "RANGE_BITS", 2)
    rng = random.Random(11)
    vocab = ["the", "the", "the", "of", "ann", "bo", "cy", "dee", "eli", "fay"]
    docs = {i: " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 12))) for i in range(80)}
    names = ["the", "of", "ann", "bo", "cy", "dee", "eli", "fay", "zed"]
    ents = {f"e{i}": [rng.choice(names) for _ in range(3)] for i in range(30)}
    ents["e_none"] = ["zed", "zed", "zed"]
    edf = spark.createDataFrame([(k, *v) for k, v in ents.items()],
                                "candid string, first string, middle string, last string")
    cdf = spark.createDataFrame([(p, f"u{p}", t) for p, t in docs.items()], "page_id long, url string, text string")
    got = {}
    for row in L.link_overlap(edf, cdf, r=r, prune_from=prune_from).collect():
        got.setdefault(row.candid, []).append((row.rank, row.page_id, row.score))
    want = {}
    for e, ns in ents.items():
        scored = sorted((-len(set(ns) & set(t.split())), p) for p, t in docs.items() if set(ns) & set(t.split()))
        if scored:
            want[e] = [(i + 1, p, -s) for i, (s, p) in enumerate(scored[:r])]
    assert {e: sorted(v) for e, v in got.items()} == want


def test_text_for_splits_a_hot_document_without_changing_rows(spark):
    """One document referenced by most pairs is copied over several salts;
    every pair still meets its text exactly once."""
    docs = spark.createDataFrame([(1, "u1", "Alpha beta"), (2, "u2", "Gamma"), (3, "u3", "unused")],
                                 "page_id long, url string, html string")
    c = Corpus(docs, F.lower("html"))
    pairs = spark.createDataFrame([(f"e{i}", 1 if i % 10 else 2, i) for i in range(50)] + [("x", 1, 99), ("x", 1, 99)],
                                  "candid string, page_id long, rank int")
    got = sorted(tuple(r) for r in c.text_for(pairs, rows_per_copy=3).collect())
    want = sorted((k, p, r, "alpha beta" if p == 1 else "gamma") for k, p, r in
                  [(f"e{i}", 1 if i % 10 else 2, i) for i in range(50)] + [("x", 1, 99), ("x", 1, 99)])
    assert got == want


def test_names_of_several_words_and_repeated_rows(spark):
    pages = [(1, "u1", "mary ann o'neil was born"), (2, "u2", "ann smith jones"), (3, "u3", "mary smith"), (4, "u4", "jones, smith"),
             (5, "u5", "o neil")]
    corpus = spark.createDataFrame(pages, "page_id long, url string, text string")
    ents = spark.createDataFrame([("a", "Mary Ann", None, "O'Neil"), ("a", "Mary Ann", None, "O'Neil"), ("b", "Ann", "", "Smith-Jones"),
                                  ("c", "Zed", "--", "Smith")], "candid string, first string, middle string, last string")
    want = {("a", 1): 2, ("a", 5): 1, ("b", 2): 2, ("b", 1): 1, ("b", 4): 1, ("c", 2): 1, ("c", 3): 1, ("c", 4): 1}
    got = [(r.candid, r.page_id, r.score) for r in L.link_overlap(ents, corpus, r=4).collect()]
    assert len(got) == len(want) and {(c, p): s for c, p, s in got} == want
    bm = L.link_bm25(ents, corpus, r=4).collect()
    assert {(r.candid, r.page_id) for r in bm} == set(want) and len(bm) == len(want)


def test_each_copy_of_an_entity_gets_its_own_row(spark):
    from dossier.plans.profiles import gather_contexts
    corpus = spark.createDataFrame([(1, "u1", "lee x"), (2, "u2", "ann zed")], "page_id long, url string, text string")
    row = ("a", "ann", None, "lee", "ann lee", "Ohio", 1990)
    ents = spark.createDataFrame([row, row, ("b", "zed", None, "q", "zed q", "Ohio", 1990)],
                                 "candid string, first string, middle string, last string, full string, state string, min_year int")
    got = [(r.candid, r.context, list(r.sources)) for r in gather_contexts(ents, corpus).collect()]
    assert sorted(got) == [("a", "lee x ann zed", ["u1", "u2"])] * 2 + [("b", "zed", ["u2"])]


@pytest.mark.parametrize("tasks", [1, 2, 4])
def test_job_rate_holds_whatever_tasks_run(spark, tasks):
    """20 calls at 20 a second over 1, 2 and 4 tasks: never more than the rate in any half second."""
    df = spark.range(20).select(F.col("id").cast("string").alias("prompt"))

    def now(prompt):
        import time
        return str(time.time())
    pol = EN.Policy(tries=1, timeout=None, job_rate=20.0, **EN.NO_WAIT)
    at = sorted(float(r.response) for r in EN.enrich(df, now, "prompt", policy=pol, partitions=tasks).collect())
    assert len(at) == 20 and at[-1] - at[0] >= 18 / 20
    assert all(sum(t <= x < t + 0.5 for x in at) <= 12 for t in at)


def test_codes_of_many_values_are_not_broadcast(spark, monkeypatch):
    """A column whose codes grow with the rows is joined by sorting; a short one is broadcast; codes are the same."""
    rows = [(i, f"v{i:04d}" if i % 7 else None, f"s{i % 3}") for i in range(600)]
    df = spark.createDataFrame(rows, "i long, v string, s string")
    monkeypatch.setattr(RK, "BROADCAST_BYTES", 1000)
    out = RK.dense_codes_many(df, ["v", "s"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=merge") == 1 and plan.count("strategy=broadcast") == 1
    values = sorted({r[1] for r in rows if r[1]})
    assert {r.i: (r.v_code, r.s_code) for r in out.collect()} == {
        i: (values.index(v) if v else -1, int(s[1])) for i, v, s in rows}


def test_ranks_give_the_codes_of_the_values(spark):
    rows = [(i, None if i % 5 == 0 else f"{'xyZ é'[i % 5]}{i * 7 % 23}") for i in range(120)]
    df = spark.createDataFrame(rows, "i long, v string")
    ranked = RK.ranked(df, ["v"])
    assert ranked.columns == df.columns
    codes = []
    for d in (df, ranked):
        fit = RK.fit_codes(d.where("i % 3 <> 0"), ["v"])
        codes.append({r.i: r.v_code for r in RK.apply_codes(d, fit, ["v"]).collect()})
    assert codes[0] == codes[1]
