"""Source / sink query bindings: CSV round trips, stored prompt tables,
shard unions, partitioned families, streaming resume, whole runs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as TY

from dossier.functions import text as T
from dossier.operators import enrich as EN
from dossier.operators import entities as E
from dossier.operators import parse as P
from dossier.operators import rerun as R
from dossier.operators.stubs import FailsFirst, rule_reply
from dossier.plans import oracle as O
from dossier.plans import views as V
from dossier.plans.catalog import register, sources_text
from dossier.plans.profiles import gather_contexts
from dossier.plans.q_entities import NORM
from dossier.plans.q_parse import REPLIES_SQL, RERUN_TOKEN_LIMIT, STUB_SQL, parsed_replies
from dossier.plans.q_text import PIPE, page_prompts
from dossier.session import materialize, scratch_path
from dossier.sources import csv as C
from dossier.streaming.resume import run_available
from dossier.streaming.retry import outcomes, run_retrying

DOC_COLS = ("doc_id", "text", "lang", "source", "n_chars")
DOC_SCHEMA = TY.StructType([TY.StructField("doc_id", TY.LongType()), TY.StructField("text", TY.StringType()),
                            TY.StructField("lang", TY.StringType()), TY.StructField("source", TY.StringType()),
                            TY.StructField("n_chars", TY.LongType())])


@register("scan_csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_scan_csv_roundtrip(spark, sf_dir):
    """Multi-line prose with quotes and commas written as CSV and read back, the
    files by blocks, in as many tasks as they have."""
    path = scratch_path(spark, "documents-csv")
    C.write_csv(V.table(spark, sf_dir, "documents").select(*DOC_COLS), path)
    return C.read_csv(spark, path, DOC_SCHEMA, split=True)


_LINK_SQL = PIPE + """
SELECT candid, first, middle, last, "full", min_year, state, sources FROM prompts"""


@register("scan_link_table", _LINK_SQL)
def q_scan_link_table(spark, sf_dir):
    """Link table written to Parquet (the hand-off) and exported as CSV with
    list literals; the CSV is imported back with the list-literal parser."""
    out = page_prompts(spark, sf_dir).select("candid", "first", "middle", "last", "full", "min_year",
                                            "state", "sources")
    pq = scratch_path(spark, "links")
    out.write.mode("overwrite").parquet(pq)
    csvp = scratch_path(spark, "links-csv")
    C.write_csv(spark.read.parquet(pq).withColumn("sources", C.list_literal("sources")), csvp)
    back = C.read_csv(spark, csvp)
    return back.select("candid", "first", "middle", "last", "full",
                       F.col("min_year").cast("int").alias("min_year"), "state",
                       F.array_join(T.parse_list_literal("sources"), "|").alias("sources"))


_PROMPT_SQL = PIPE + """
SELECT candid, "full" AS full_name, min_year, state, prompt, sources FROM prompts"""


def _prompt_table(spark, sf_dir, variant):
    pr = page_prompts(spark, sf_dir).select("prompt", "sources", F.col("full").alias("full_name"),
                                           "min_year", "state", "candid")
    path = scratch_path(spark, f"prompts-{variant}")
    C.write_prompt_table(pr, path, variant)
    back = C.read_prompt_table(spark, path, variant)
    return back.select("candid", "full_name", "min_year", "state", "prompt",
                       sources_text().alias("sources"))


@register("scan_prompts", _PROMPT_SQL)
def q_scan_prompts(spark, sf_dir):
    return _prompt_table(spark, sf_dir, "regular")


@register("header_variants", _PROMPT_SQL)
def q_header_variants(spark, sf_dir):
    return _prompt_table(spark, sf_dir, "condensed")


WIDE_SCHEMA = TY.StructType([
    TY.StructField("candid", TY.StringType()), TY.StructField("name", TY.StringType()),
    TY.StructField("state", TY.StringType()), TY.StructField("min_year", TY.IntegerType()),
    *[TY.StructField(c, TY.StringType()) for c in P.FOUR_FIELDS],
    TY.StructField("sources", TY.StringType()), TY.StructField("confidence", TY.StringType()),
])
SHARD_EDGES = (333, 666)


def _shard_sql():
    return REPLIES_SQL + f"""
SELECT candid, name, state, min_year, college_major, undergraduate_institution, highest_degree, work_history,
       sources, CASE WHEN "row" >= {SHARD_EDGES[1]} THEN NULL ELSE confidence END AS confidence
FROM parsed WHERE parsed"""


@register("union_shards", _shard_sql())
def q_union_shards(spark, sf_dir):
    """Results written as three CSV shards with different column orders (the
    last one without ``confidence``), then unioned by name per file; the
    combined table goes to its own folder, not into the shard folder."""
    wide = materialize(parsed_replies(spark, sf_dir).filter("parsed"), "wide")
    base = scratch_path(spark, "shards")
    cols = [f.name for f in WIDE_SCHEMA.fields]
    lo, hi = SHARD_EDGES
    C.write_csv(wide.filter(F.col("row") < lo).select(*cols), f"{base}/shard0")
    C.write_csv(wide.filter((F.col("row") >= lo) & (F.col("row") < hi)).select(*reversed(cols)), f"{base}/shard1")
    C.write_csv(wide.filter(F.col("row") >= hi).select(*[c for c in cols if c != "confidence"]), f"{base}/shard2")
    combined = C.union_shards(spark, C.list_shards(spark, base), WIDE_SCHEMA)
    out = scratch_path(spark, "combined")
    combined.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


FAMILY_GROUP = "0-96"


@register("union_family", REPLIES_SQL + """
SELECT candid, name, state, min_year, college_major, undergraduate_institution, highest_degree, work_history,
       sources, confidence FROM parsed WHERE parsed AND "row" < 97""")
def q_union_family(spark, sf_dir):
    """Outputs and parse errors stored as one table partitioned by
    (kind, grp); one family/group is read back with partition pruning."""
    parsed = parsed_replies(spark, sf_dir).withColumn("grp", E.range_group(width=97))
    outs = parsed.filter("parsed").select(*[f.name for f in WIDE_SCHEMA.fields], "grp").withColumn(
        "kind", F.lit("outputs"))
    errs = parsed.filter(~F.col("parsed")).select("candid", "response", "grp").withColumn(
        "kind", F.lit("parse_errors"))
    path = scratch_path(spark, "families")
    C.write_family(outs.unionByName(errs, allowMissingColumns=True), path)
    fam = C.read_family(spark, path, {"kind": "outputs", "grp": FAMILY_GROUP})
    return fam.select(*[f.name for f in WIDE_SCHEMA.fields])


_RESUME_SQL = "WITH " + NORM + """,
called AS (SELECT *, list_filter(string_split(concat_ws(' ', "full", state), ' '), lambda x: x <> '') AS w FROM norm)
SELECT candid, CAST("row" % 2 AS INTEGER) AS arrival, 'ok' AS status,
  CASE WHEN len(w) > 0 THEN w[1] ELSE 'N/A' END AS college_major,
  CASE WHEN len(w) > 1 THEN w[2] || ' university' ELSE 'N/A' END AS undergraduate_institution,
  CASE WHEN len(w) > 2 THEN w[3] ELSE 'N/A' END AS work_history FROM called"""


@register("resume_stream", _RESUME_SQL)
def q_resume_stream(spark, sf_dir):
    """Two arrivals of input files processed by two runs of the same
    streaming query; the second run only takes the new files."""
    ents = E.normalise(V.entities(spark, sf_dir)).select("candid", "row", "full", "state", "min_year")
    base = scratch_path(spark, "resume")
    inp, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"

    def job(batch):
        prompts = batch.withColumn("prompt", F.concat_ws(" ", "full", "state"))
        pol = EN.Policy(tries=1, timeout=None, token_limit=None, **EN.NO_WAIT)
        return EN.enrich(prompts, rule_reply, "prompt", policy=pol).select("candid", "status", "response")

    for arrival in (0, 1):
        ents.filter(F.col("row") % 2 == arrival).write.mode("append").parquet(inp)
        run_available(spark, inp, ents.schema, out, ckpt, job)
    got = P.parse_replies(spark.read.parquet(out).withColumnRenamed("batch_id", "arrival"), "response")
    return got.select("candid", F.col("arrival").cast("int").alias("arrival"), "status", "college_major",
                      "undergraduate_institution", "work_history")


@register("retry_stream", "WITH " + NORM + """,
asked AS (SELECT *, concat_ws(' ', "full", state, '#' || candid) AS prompt FROM norm)
SELECT candid, CASE WHEN "row" % 4 < 3 THEN 'ok' ELSE 'error' END AS status,
  CAST(least("row" % 4 + 1, 3) AS INTEGER) AS attempts,
  CASE WHEN "row" % 4 < 3 THEN 'profile of ' || prompt END AS response FROM asked""")
def q_retry_stream(spark, sf_dir):
    """The retry queue as stream state: two arrivals, the second with every
    request of the first again, a stop between them, failures tried again by
    timer; one outcome per request."""
    ents = E.normalise(V.entities(spark, sf_dir))
    asked = ents.select("row", F.col("candid").alias("key"), F.concat_ws(
        " ", "full", "state", F.concat(F.lit("#"), "candid")).alias("prompt"))
    base = scratch_path(spark, "retries")
    inp, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    pol = EN.Policy(tries=3, wait_min=0.1, wait_max=0.4, timeout=None)
    asked.filter(F.col("row") % 2 == 0).select("key", "prompt").write.parquet(inp)
    run_retrying(spark, inp, out, ckpt, FailsFirst(), pol, seconds=3)
    asked.select("key", "prompt").write.mode("append").parquet(inp)
    run_retrying(spark, inp, out, ckpt, FailsFirst(), pol)
    return outcomes(spark, out).select(F.col("key").alias("candid"), "status", "attempts", "response")


# --- whole runs -----------------------------------------------------------------

# a row that no table has, six that all have, one of them twice
SMOKE_ITEMS = (126073, 0, 27, 5, 14, 27, 31, 38)
_VALUES = ", ".join(f"('{i}')" for i in SMOKE_ITEMS)
_STUB_FIELDS = """
  CASE WHEN len(w) > 0 THEN w[1] ELSE 'N/A' END AS college_major,
  CASE WHEN len(w) > 1 THEN w[2] || ' university' ELSE 'N/A' END AS undergraduate_institution,
  'N/A' AS highest_degree,
  CASE WHEN len(w) > 2 THEN w[3] ELSE 'N/A' END AS work_history,
  CAST(least(100, len(w)) AS VARCHAR) AS confidence"""


def _run(spark, sf_dir, entities, token_limit):
    ctx = gather_contexts(entities, V.page_corpus(spark, sf_dir), r=4)
    pol = EN.Policy(tries=1, timeout=None, token_limit=token_limit, **EN.NO_WAIT)
    return materialize(EN.enrich(ctx.select("candid", "full", "state", "min_year", "sources", "prompt"),
                                 rule_reply, "prompt", policy=pol,
                                 partitions=spark.sparkContext.defaultParallelism), "enriched")


@register("profile_rows", STUB_SQL + f"""
SELECT candid, p."full", p.state, p.min_year, p.sources, c.status, {_STUB_FIELDS.strip().replace(chr(10), ' ')}
FROM (VALUES {_VALUES}) v(candid) JOIN called c USING (candid) JOIN prompts p USING (candid)
WHERE c.status = 'ok'""")
def q_profile_rows(spark, sf_dir):
    """Selected rows only (by row number), then the whole chain: link,
    excerpt, prompt, enrich, parse; the results table."""
    ents = E.select_rows(spark, V.text_entities(spark, sf_dir), SMOKE_ITEMS).drop("pos")
    results, _ = R.split_outcomes(_run(spark, sf_dir, ents, 4096))
    return results.select("candid", "full", "state", "min_year", sources_text().alias("sources"), "status",
                          *P.ANSWER_COLS)


@register("profile_rerun", STUB_SQL + f""",
runs AS (
  SELECT candid, w, CASE WHEN status = 'ok' THEN 1 ELSE 2 END AS attempt,
         CASE WHEN status = 'ok' OR {O.estimated_tokens('prompt')} <= {RERUN_TOKEN_LIMIT} THEN 'ok' ELSE 'prompt' END AS status
  FROM called)
SELECT candid, attempt, status, {_STUB_FIELDS.strip().replace(chr(10), ' ')} FROM runs WHERE status = 'ok'
UNION ALL
SELECT candid, attempt, status, NULL, NULL, NULL, NULL, NULL FROM runs WHERE status <> 'ok'""")
def q_profile_rerun(spark, sf_dir):
    """Full run, then the prompt-error queue replayed with a larger budget;
    final table = results of both attempts plus what is still failing."""
    first = _run(spark, sf_dir, V.text_entities(spark, sf_dir), 4096)
    res1, dead1 = R.split_outcomes(first)
    queue = R.failure_queue(dead1, res1, stages=(R.STAGE_PROMPT,))
    pol = EN.Policy(tries=1, timeout=None, token_limit=RERUN_TOKEN_LIMIT, **EN.NO_WAIT)
    again = materialize(EN.enrich(R.replay_keys(first.drop("response", "status", "reason", "attempts"), queue),
                                  rule_reply, "prompt", policy=pol), "rerun")
    res2, dead2 = R.split_outcomes(again)
    cols = ["candid", "status", *P.ANSWER_COLS]
    ok = (res1.select(*cols).withColumn("attempt", F.lit(1))
          .unionByName(res2.select(*cols).withColumn("attempt", F.lit(2))))
    still = dead2.select("candid", F.col("stage").alias("status"), F.lit(2).alias("attempt"))
    return ok.unionByName(still, allowMissingColumns=True).select("candid", "attempt", "status", *P.ANSWER_COLS)
