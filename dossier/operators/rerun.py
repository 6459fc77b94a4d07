"""Dead letters, failure queues, reruns and appends (R-6..R-8, J-7, J-8,
U-B, K-3, K-5..K-7, K-10); the table of the latest attempts is ``sources.attempts``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from dossier.operators import enrich as EN
from dossier.operators import ranking as RK
from dossier.operators.parse import parse_replies, reply_map

# dead-letter stages
STAGE_PROMPT, STAGE_ENRICH, STAGE_TIMEOUT, STAGE_PARSE = "prompt", "enrich", "timeout", "parse"
# what becomes of a row
STAGE_FINAL = "final"
OUTCOMES = (STAGE_FINAL, STAGE_PROMPT, STAGE_ENRICH, STAGE_TIMEOUT, STAGE_PARSE)
PARSE_REASON = "reply is not one JSON object"


def split_outcomes(enriched: DataFrame, reply: str = "response") -> tuple[DataFrame, DataFrame]:
    """Materialised enrichment output -> (parsed results, dead letters).
    Dead letters keep every input column plus ``stage`` and ``reason``, so
    they can be fed back as input; |input| = |results| + |dead letters|."""
    base = [c for c in enriched.columns if c not in ("response", "status", "reason", "attempts")]
    called = parse_replies(enriched.filter(F.col("status") == EN.STATUS_OK), reply)
    results = called.filter("parsed").drop("parsed")
    stage = (F.when(F.col("status") == EN.STATUS_PROMPT, STAGE_PROMPT)
             .when(F.col("status") == EN.STATUS_TIMEOUT, STAGE_TIMEOUT)
             .otherwise(STAGE_ENRICH))
    failed = enriched.filter(F.col("status") != EN.STATUS_OK).select(
        *base, stage.alias("stage"), "reason", "response", "attempts")
    unparsed = called.filter(~F.col("parsed")).select(
        *base, F.lit(STAGE_PARSE).alias("stage"), F.lit(PARSE_REASON).alias("reason"),
        "response", "attempts")
    return results, failed.unionByName(unparsed)


def failure_queue(dead: DataFrame, results: DataFrame, key: str = "candid",
                  stages=(STAGE_PROMPT,)) -> DataFrame:
    """Keys still failing: dead letters of the given stages that have no
    successful result (anti-join), one row per key."""
    q = dead.filter(F.col("stage").isin(*stages)).join(results.select(key), key, "left_anti")
    # of several dead letters the first in order of all columns stays
    row = F.min(F.struct(*[c for c in q.columns if c != key])).alias("_r")
    return q.groupBy(key).agg(row).select(key, "_r.*").select(*q.columns)


def replay_keys(source: DataFrame, queue: DataFrame, key: str = "candid") -> DataFrame:
    """Input rows whose key is in the failure queue (semi-join)."""
    return source.join(queue.select(key), key, "left_semi")


def prompt_key(key: str = "candid", prompt: str = "prompt") -> F.Column:
    """Identity of one call: the entity key and a hash of the exact prompt."""
    return F.concat_ws(":", F.col(key).cast("string"), F.sha2(F.col(prompt), 256))


def pending(prompts: DataFrame, done: DataFrame, key: str = "candid", prompt: str = "prompt") -> DataFrame:
    """Prompts that have no successful call yet (anti-join on key + prompt
    hash), so a replay after a crash or a partial run never pays twice for
    the same call; a changed prompt for the same key is called again."""
    ok = done.filter(F.col("status") == EN.STATUS_OK).select(prompt_key(key, prompt).alias("_pk"))
    return (prompts.withColumn("_pk", prompt_key(key, prompt))
            .join(ok, "_pk", "left_anti").drop("_pk"))


def offset_queue(queue: DataFrame, k: int = 0, order: str = "row") -> DataFrame:
    """Queue in row order without its first k entries (k = 0 keeps all).

    ``orderBy().offset(k)`` would run as one global limit in a single task;
    the exact position comes from the range-partitioned ``ordered_index``
    instead, so every step stays parallel."""
    if k < 0:
        raise ValueError("k must be >= 0")
    if not k:
        return queue
    return RK.ordered_index(queue, [order], name="_q").filter(F.col("_q") >= k).drop("_q")


def outcome_counts(enriched: DataFrame, reply: str = "response") -> tuple[DataFrame, Observation]:
    """``enriched`` and an observation of it: rows in all and per outcome (final,
    or the stage that failed). The counts come with the one write of the run, so
    no report has to scan its table."""
    status, parsed = F.col("status"), reply_map(reply).isNotNull()
    stage = (F.when(status == EN.STATUS_PROMPT, STAGE_PROMPT).when(status == EN.STATUS_TIMEOUT, STAGE_TIMEOUT)
             .when(status != EN.STATUS_OK, STAGE_ENRICH).when(parsed, STAGE_FINAL).otherwise(STAGE_PARSE))
    seen = Observation()
    return enriched.observe(seen, F.count(F.lit(1)).alias("entities"), *[
        F.coalesce(F.sum((stage == s).cast("long")), F.lit(0)).alias(s) for s in OUTCOMES]), seen


def append_attempt(df: DataFrame, path: str, attempt: int) -> None:
    """Append one attempt's rows to a Parquet table that keeps every attempt;
    mode 'overwrite' for the first attempt, 'append' afterwards (re-running an
    attempt = write it again under a new attempt number, nothing is lost)."""
    mode = "overwrite" if attempt == 1 else "append"
    df.withColumn("attempt", F.lit(attempt)).write.mode(mode).parquet(path)


def latest_attempt(table: DataFrame, key: str = "candid") -> DataFrame:
    """Latest row per key of such a table. Groups hold one row per attempt (bounded)."""
    w = Window.partitionBy(key).orderBy(F.col("attempt").desc())
    return table.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def missing_entities(entities: DataFrame, results: DataFrame, key: str = "candid") -> DataFrame:
    """Entities without a final result (anti-join)."""
    return entities.join(results.select(key), key, "left_anti")
