"""Entity-table query bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.functions.states import decode_state
from dossier.operators import assemble as A
from dossier.operators import entities as E
from dossier.plans import oracle as O
from dossier.plans import views as V
from dossier.plans.catalog import register

NORM = O.ENTITIES + f""",
norm AS (
  SELECT "row", candid, lower(first) AS first, lower(middle) AS middle, lower(last) AS last,
         lower(concat_ws(' ', first, middle, last, suffix)) AS "full", min_year,
         {O.decode_state('sab')} AS state
  FROM entities)"""

SAMPLE_N, SAMPLE_SEED = 20, 7
FIRST_N = 50
SMOKE_ROWS = (126073, 0, 27, 44, 46, 27)   # named smoke row, default list, a duplicate
GROUP_WIDTH = 97                           # the table is short: 97 rows per range here
SPLIT_ROW = 745


def _norm(spark, sf_dir):
    return E.normalise(V.entities(spark, sf_dir))


@register("normalise_entities", "WITH " + NORM + "\nSELECT * FROM norm")
def normalise_entities(spark, sf_dir):
    return _norm(spark, sf_dir)


@register("decode_state", "WITH " + O.ENTITIES + f"""
SELECT candid, sab, {O.decode_state('sab')} AS state FROM entities""")
def q_decode_state(spark, sf_dir):
    return V.entities(spark, sf_dir).select("candid", "sab", decode_state("sab").alias("state"))


@register("title_case", "WITH " + NORM + f"""
SELECT candid, "full", {O.title_case('"full"')} AS title FROM norm""")
def q_title_case(spark, sf_dir):
    return _norm(spark, sf_dir).select("candid", "full", E.title("full").alias("title"))


@register("query_text", "WITH " + NORM + f"""
SELECT candid, concat_ws(' ', {O.title_case('"full"')}, state) AS query FROM norm""")
def q_query_text(spark, sf_dir):
    return _norm(spark, sf_dir).select("candid", A.query_text("full", "state").alias("query"))


@register("sample_distinct", "WITH " + NORM + f""",
keyed AS (SELECT *, md5('{SAMPLE_SEED}:' || candid) AS k FROM norm),
best AS (SELECT *, row_number() OVER (PARTITION BY "full" ORDER BY k) AS rn FROM keyed)
SELECT "full", "row", candid, first, middle, last, min_year, state
FROM best WHERE rn = 1 ORDER BY k LIMIT {SAMPLE_N}""")
def q_sample_distinct(spark, sf_dir):
    return E.sample_distinct(_norm(spark, sf_dir), SAMPLE_N, seed=SAMPLE_SEED)


@register("first_n", "WITH " + NORM + f"""
SELECT * FROM norm WHERE "row" < {FIRST_N}""")
def q_first_n(spark, sf_dir):
    return E.first_n(_norm(spark, sf_dir), FIRST_N)


_VALUES = ", ".join(f"({i}, {r})" for i, r in enumerate(SMOKE_ROWS))


@register("select_rows", "WITH " + NORM + f""",
wanted(pos, "row") AS (VALUES {_VALUES})
SELECT n."row", w.pos, n.candid, n.first, n.middle, n.last, n."full", n.min_year, n.state
FROM wanted w JOIN norm n ON n."row" = w."row" """)
def q_select_rows(spark, sf_dir):
    return E.select_rows(spark, _norm(spark, sf_dir), SMOKE_ROWS)


def _range_sql(width: int, groups: int = E.RANGE_GROUP_COUNT) -> str:
    g = f"CAST(least(floor(\"row\" / {width}), {groups - 1}) AS BIGINT)"
    return (f"CASE WHEN {g} = {groups - 1} THEN CAST({g} * {width} AS VARCHAR) || '-end' "
            f"ELSE CAST({g} * {width} AS VARCHAR) || '-' || CAST({g} * {width} + {width - 1} AS VARCHAR) END")


@register("range_groups", "WITH " + NORM + f"""
SELECT candid, "row", {_range_sql(GROUP_WIDTH)} AS range_group FROM norm""")
def q_range_groups(spark, sf_dir):
    return _norm(spark, sf_dir).select("candid", "row",
                                       E.range_group(width=GROUP_WIDTH).alias("range_group"))


@register("batch_number", "WITH " + NORM + """
SELECT candid, "row", CAST(floor("row" / 100) AS BIGINT) AS batch FROM norm""")
def q_batch_number(spark, sf_dir):
    return E.batch_range(_norm(spark, sf_dir)).select("candid", "row", "batch")


@register("positional_split", "WITH " + NORM + f"""
SELECT candid, "row", CASE WHEN "row" < {SPLIT_ROW} THEN 'train_test' ELSE 'validation' END AS part
FROM norm""")
def q_positional_split(spark, sf_dir):
    return _norm(spark, sf_dir).select(
        "candid", "row",
        F.when(F.col("row") < SPLIT_ROW, "train_test").otherwise("validation").alias("part"))
