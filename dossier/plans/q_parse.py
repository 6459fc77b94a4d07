"""Parse, enrichment, dead-letter and rerun query bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.functions import text as T
from dossier.operators import assemble as A
from dossier.operators import enrich as EN
from dossier.operators import entities as E
from dossier.operators import parse as P
from dossier.operators import rerun as R
from dossier.operators.stubs import RecordedService, birth_reply, rule_reply
from dossier.plans import oracle as O
from dossier.plans import views as V
from dossier.plans.catalog import register
from dossier.plans.q_entities import NORM
from dossier.plans.q_text import PIPE, page_prompts
from dossier.session import materialize, scratch_path
from dossier.sources import attempts as AT
from dossier.sources.csv import read_csv, write_csv

ANSWERS = list(P.ANSWER_COLS)
#: Documents beyond so many characters time out in the first run.
SIZE_LIMIT = 8000
RERUN_TOKEN_LIMIT = 8192
QUEUE_OFFSET = 10
CALLS_PER_TASK = 32

REPLIES_SQL = O.with_(O.REPLIES, f"""parsed AS (
  SELECT *, {O.parsed_cols('response')} FROM replies)""")


def parsed_replies(spark, sf_dir):
    return P.parse_replies(V.replies(spark, sf_dir), "response")


@register("parse_json", REPLIES_SQL + """
SELECT candid, parsed, college_major, undergraduate_institution, highest_degree, work_history,
       confidence, extra_keys, TRY_CAST(confidence AS INTEGER) AS confidence_int FROM parsed""")
def q_parse_json(spark, sf_dir):
    return parsed_replies(spark, sf_dir).select("candid", "parsed", *ANSWERS, "extra_keys", "confidence_int")


@register("parse_errors", REPLIES_SQL + f"""
SELECT candid, response, 'parse' AS stage, {O.q(R.PARSE_REASON)} AS reason FROM parsed WHERE NOT parsed""")
def q_parse_errors(spark, sf_dir):
    return (parsed_replies(spark, sf_dir).filter(~F.col("parsed"))
            .select("candid", "response", F.lit(R.STAGE_PARSE).alias("stage"),
                    F.lit(R.PARSE_REASON).alias("reason")))


WIDE = ["name", "state", "min_year", "candid", *ANSWERS[:4], "sources", "confidence", "confidence_int"]


@register("extract_wide", REPLIES_SQL + """
SELECT name, state, min_year, candid, college_major, undergraduate_institution, highest_degree,
       work_history, sources, confidence, TRY_CAST(confidence AS INTEGER) AS confidence_int
FROM parsed WHERE parsed""")
def q_extract_wide(spark, sf_dir):
    return parsed_replies(spark, sf_dir).filter("parsed").select(*WIDE)


@register("null_tokens", REPLIES_SQL + f"""
SELECT candid, {O.null_tokens('college_major')} AS college_major,
       {O.null_tokens('undergraduate_institution')} AS undergraduate_institution,
       {O.null_tokens('highest_degree')} AS highest_degree,
       {O.null_tokens('work_history')} AS work_history
FROM parsed WHERE parsed""")
def q_null_tokens(spark, sf_dir):
    p = parsed_replies(spark, sf_dir).filter("parsed").select("candid", *ANSWERS[:4])
    return P.null_answer_tokens(p)


@register("birth_year", """
WITH br AS (SELECT CAST(doc_id AS VARCHAR) AS candid,
  CASE doc_id % 4 WHEN 0 THEN CAST(1940 + doc_id % 60 AS VARCHAR)
                  WHEN 1 THEN 'Graduated in ' || CAST(1960 + doc_id % 50 AS VARCHAR)
                  WHEN 2 THEN 'N/A'
                  ELSE 'He was born in ' || CAST(1930 + doc_id % 70 AS VARCHAR) || ' and graduated in '
                       || CAST(1955 + doc_id % 70 AS VARCHAR) END AS reply FROM documents)
SELECT candid, reply, coalesce(TRY_CAST(nullif(regexp_extract(reply, """ + O.q(P.BORN_YEAR) + """, 1), '') AS INTEGER),
                               TRY_CAST(nullif(regexp_extract(reply, """ + O.q(P.GRAD_YEAR) + f""", 1), '') AS INTEGER)
                               - {P.GRADUATION_AGE}) AS birth_year FROM br""")
def q_birth_year(spark, sf_dir):
    b = V.birth_replies(spark, sf_dir)
    return b.select("candid", "reply", P.birth_year("reply").alias("birth_year"))


REQUIRED = ("candid", "first", "middle", "last", "state")


@register("completeness_guard", "WITH " + NORM + """
SELECT candid, CASE WHEN middle IS NULL THEN 'incomplete' ELSE 'ok' END AS status,
       CASE WHEN middle IS NULL THEN 'middle' ELSE '' END AS missing FROM norm""")
def q_completeness_guard(spark, sf_dir):
    n = E.normalise(V.entities(spark, sf_dir))
    return E.completeness(n, REQUIRED).select("candid", "status", "missing")


# --- enrichment over the page prompts with the rule-based stub -------------------

def stub_run(spark, sf_dir, token_limit=A.PROMPT_TOKEN_LIMIT):
    prompts = page_prompts(spark, sf_dir).select("candid", "full", "state", "min_year", "prompt")
    pol = EN.Policy(tries=1, timeout=None, token_limit=token_limit, **EN.NO_WAIT)
    return materialize(EN.enrich(prompts, rule_reply, "prompt", policy=pol,
                                 partitions=spark.sparkContext.defaultParallelism))


_WORDS = f"list_filter(string_split({O.recover_excerpt('prompt')}, ' '), lambda w: w <> '')"
STUB_SQL = PIPE + f""",
called AS (
  SELECT candid, prompt, {_WORDS} AS w,
         CASE WHEN {O.estimated_tokens('prompt')} > {A.PROMPT_TOKEN_LIMIT} THEN 'prompt' ELSE 'ok' END AS status
  FROM prompts)"""


@register("enrich_stub", STUB_SQL + """
SELECT candid, status, status = 'ok' AS parsed,
  CASE WHEN status <> 'ok' THEN '' WHEN len(w) > 0 THEN w[1] ELSE 'N/A' END AS college_major,
  CASE WHEN status <> 'ok' THEN '' WHEN len(w) > 1 THEN w[2] || ' university' ELSE 'N/A' END AS undergraduate_institution,
  CASE WHEN status <> 'ok' THEN '' ELSE 'N/A' END AS highest_degree,
  CASE WHEN status <> 'ok' THEN '' WHEN len(w) > 2 THEN w[3] ELSE 'N/A' END AS work_history,
  CASE WHEN status <> 'ok' THEN '' ELSE CAST(least(100, len(w)) AS VARCHAR) END AS confidence
FROM called""")
def q_enrich_stub(spark, sf_dir):
    out = P.parse_replies(stub_run(spark, sf_dir), "response")
    return out.select("candid", "status", "parsed", *ANSWERS)


@register("rerun_prompt_errors", STUB_SQL + f"""
SELECT candid, CASE WHEN {O.estimated_tokens('prompt')} > {RERUN_TOKEN_LIMIT} THEN 'prompt' ELSE 'ok' END AS status
FROM called WHERE status = 'prompt'""")
def q_rerun_prompt_errors(spark, sf_dir):
    first = stub_run(spark, sf_dir)
    results, dead = R.split_outcomes(first)
    queue = R.failure_queue(dead, results, stages=(R.STAGE_PROMPT,))
    prompts = R.replay_keys(first.select("candid", "prompt"), queue)
    pol = EN.Policy(tries=1, timeout=None, token_limit=RERUN_TOKEN_LIMIT, **EN.NO_WAIT)
    again = materialize(EN.enrich(prompts, rule_reply, "prompt", policy=pol))
    return again.select("candid", "status")


_YEAR = f"""coalesce(TRY_CAST(nullif(regexp_extract(reply, {O.q(P.BORN_YEAR)}, 1), '') AS INTEGER),
                TRY_CAST(nullif(regexp_extract(reply, {O.q(P.GRAD_YEAR)}, 1), '') AS INTEGER) - {P.GRADUATION_AGE})"""


@register("birth_year_run", STUB_SQL + f""",
replied AS (SELECT candid, CASE WHEN len(w) = 0 THEN 'N/A' WHEN len(w) % 2 = 1 THEN 'Graduated in ' || CAST(1960 + len(w) % 50 AS VARCHAR)
                           ELSE CAST(1940 + len(w) % 60 AS VARCHAR) END AS reply FROM called)
SELECT candid, reply AS birth_year, {_YEAR} AS birth_year_int FROM replied""")
def q_birth_year_run(spark, sf_dir):
    """Birth years as a run: the excerpt recovered from each stored prompt, the
    new prompt, the call, one CSV file of (Candid, Birth Year) read back."""
    stored = page_prompts(spark, sf_dir)
    prompts = stored.select("candid", A.birth_year_prompt("full", "state", T.recover_excerpt("prompt")).alias("prompt"))
    pol = EN.Policy(tries=6, timeout=None, token_limit=None, **EN.NO_WAIT)
    called = materialize(EN.enrich(prompts, birth_reply, "prompt", policy=pol,
                                   partitions=spark.sparkContext.defaultParallelism))
    path = scratch_path(spark, "birth-years")
    answered = called.filter(F.col("status") == EN.STATUS_OK)
    write_csv(answered.select(F.col("candid").alias("Candid"), F.col("response").alias("Birth Year")), path)
    back = read_csv(spark, path, split=True)
    return back.select(F.col("Candid").alias("candid"), F.col("Birth Year").alias("birth_year"),
                       P.birth_year("Birth Year").alias("birth_year_int"))


# --- a run over the entity table, answered from the recorded replies --------------

def route_prompts(spark, sf_dir):
    """Entities with the reply recorded for them, if any, and its document's size."""
    ents = E.normalise(V.entities(spark, sf_dir))
    given = F.concat(F.col("n_chars").cast("string"), F.lit(":"), F.col("response"))
    replies = V.replies(spark, sf_dir).select("candid", given.alias("given"))
    return ents.join(replies, "candid", "left").select(
        "candid", "row", "full", "state", "min_year", "given", A.query_text("full", "state").alias("prompt"))


def route_calls(spark, sf_dir, tries=3):
    pol = EN.Policy(tries=tries, timeout=None, token_limit=None, concurrency=CALLS_PER_TASK, **EN.NO_WAIT)
    return EN.enrich(route_prompts(spark, sf_dir), RecordedService(SIZE_LIMIT), "prompt", key_col="given",
                     policy=pol, partitions=spark.sparkContext.defaultParallelism)


def route_run(spark, sf_dir, tries=3):
    return materialize(route_calls(spark, sf_dir, tries))


def route_counts(spark, sf_dir):
    """The run's counts by outcome, observed on its one write."""
    calls, seen = R.outcome_counts(route_calls(spark, sf_dir))
    materialize(calls)
    return seen.get


ROUTE_SQL = O.with_(NORM, O.REPLIES, f"""parsed AS (
  SELECT *, {O.parsed_cols('response')} FROM replies),
outcome AS (
  SELECT n.candid, n."row",
    CASE WHEN p.candid IS NULL THEN 'enrich' WHEN p.n_chars > {SIZE_LIMIT} THEN 'timeout'
         WHEN NOT p.parsed THEN 'parse' ELSE 'final' END AS stage,
    CASE WHEN p.candid IS NULL THEN 'LookupError: no record for this entity'
         WHEN p.n_chars > {SIZE_LIMIT} THEN 'TimeoutError: ' || CAST(p.n_chars AS VARCHAR) || ' characters'
         WHEN NOT p.parsed THEN {O.q(R.PARSE_REASON)} ELSE NULL END AS reason
  FROM norm n LEFT JOIN parsed p ON n.candid = p.candid)
""")


@register("enrich_retry", ROUTE_SQL + """
SELECT candid, CASE stage WHEN 'enrich' THEN 'error' WHEN 'timeout' THEN 'timeout' ELSE 'ok' END AS status,
       CAST(CASE WHEN stage IN ('enrich', 'timeout') THEN 3 ELSE 1 END AS INTEGER) AS attempts
FROM outcome""")
def q_enrich_retry(spark, sf_dir):
    return route_run(spark, sf_dir).select("candid", "status", "attempts")


@register("route_failures", ROUTE_SQL + "SELECT candid, stage, reason FROM outcome WHERE stage <> 'final'")
def q_route_failures(spark, sf_dir):
    _, dead = R.split_outcomes(route_run(spark, sf_dir))
    return dead.select("candid", "stage", "reason")


@register("missing_entities", ROUTE_SQL + "SELECT candid FROM outcome WHERE stage <> 'final'")
def q_missing_entities(spark, sf_dir):
    results, _ = R.split_outcomes(route_run(spark, sf_dir))
    ents = E.normalise(V.entities(spark, sf_dir))
    return R.missing_entities(ents, results).select("candid")


@register("loss_funnel", ROUTE_SQL + """
SELECT stage, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM outcome GROUP BY stage""")
def q_loss_funnel(spark, sf_dir):
    counts = {k: v for k, v in route_counts(spark, sf_dir).items() if k != "entities" and v}
    total = sum(counts.values())
    return spark.createDataFrame([(k, n, round(n / total, 6)) for k, n in counts.items()], "stage string, n long, share double")


@register("stage_counts", ROUTE_SQL + """
SELECT 'entities' AS stage, count(*) AS n FROM outcome
UNION ALL SELECT 'results', count(*) FROM outcome WHERE stage = 'final'
UNION ALL SELECT 'dead_letters', count(*) FROM outcome WHERE stage <> 'final'""")
def q_stage_counts(spark, sf_dir):
    seen = route_counts(spark, sf_dir)
    dead = seen["entities"] - seen[R.STAGE_FINAL]
    return spark.createDataFrame([("entities", seen["entities"]), ("results", seen[R.STAGE_FINAL]), ("dead_letters", dead)],
                                 "stage string, n long")


@register("rerun_offset", ROUTE_SQL + f"""
SELECT candid, stage FROM outcome WHERE stage <> 'final' ORDER BY "row" OFFSET {QUEUE_OFFSET}""")
def q_rerun_offset(spark, sf_dir):
    _, dead = R.split_outcomes(route_run(spark, sf_dir))
    return R.offset_queue(dead, QUEUE_OFFSET, order="row").select("candid", "stage")


@register("rerun_timeouts", ROUTE_SQL + """
SELECT candid, 'ok' AS status, CAST(1 AS INTEGER) AS attempts FROM outcome WHERE stage = 'timeout'""")
def q_rerun_timeouts(spark, sf_dir):
    _, dead = R.split_outcomes(route_run(spark, sf_dir))
    again = dead.filter(F.col("stage") == R.STAGE_TIMEOUT).drop("stage", "reason", "response", "attempts")
    pol = EN.Policy(tries=3, timeout=30.0, token_limit=None, **EN.NO_WAIT)
    out = materialize(EN.enrich(again, RecordedService(), "prompt", key_col="given", policy=pol))
    return out.select("candid", "status", "attempts")


@register("rerun_append", ROUTE_SQL + """
SELECT candid, CASE WHEN stage IN ('enrich', 'timeout') THEN 2 ELSE 1 END AS attempt, 'ok' AS status
FROM outcome""")
def q_rerun_append(spark, sf_dir):
    first = route_run(spark, sf_dir)
    path = scratch_path(spark, "reruns")
    AT.upsert(first.select("candid", "status"), path, 1)
    # replay only calls without a successful reply (keyed by entity + prompt hash)
    failed = R.pending(first.drop("response", "status", "reason", "attempts"), first)
    pol = EN.Policy(tries=3, timeout=30.0, token_limit=None, **EN.NO_WAIT)
    second = EN.enrich(failed, RecordedService(otherwise="{}"), "prompt", key_col="given", policy=pol)
    AT.upsert(second.select("candid", "status"), path, 2)
    return AT.read(spark, path).select("candid", "attempt", "status")
