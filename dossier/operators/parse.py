"""Reply parsing into the fixed wide schema, with dead-letter routing
(F-17..F-20, F-22, U-3, R-8). Native expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.functions import text as T

# --- fixed values that must equal the reference ------------------------------
# Answer keys read from a reply (case-sensitive), in output order.
ANSWER_KEYS = ("College Major", "Undergraduate Institution",
               "Highest Degree and Institution", "Work History", "Confidence Level")
# Years subtracted from an undergraduate graduation year to estimate birth.
GRADUATION_AGE = 22
# --- end of fixed values -------------------------------------------------------

ANSWER_COLS = ("college_major", "undergraduate_institution", "highest_degree",
               "work_history", "confidence")
FOUR_FIELDS = ANSWER_COLS[:4]
REPLY_MAP = "map<string,string>"

# a bare NaN or Infinity as a value: before it a colon, after it a comma or brace
BARE_NUMBER = r"(\":\s*)(NaN|-?Infinity)(?=\s*[,}])"
BORN_YEAR = r"(?i)(?:^\s*|born\D{0,20})(\d{4})\b"
GRAD_YEAR = r"(?i)graduat\D{0,30}(\d{4})\b"


def reply_map(reply) -> F.Column:
    """Reply -> map of its top-level keys, or null when it is not exactly
    one JSON object. Newlines are removed first (as the reference does).
    The guards reject what Spark's reader would otherwise accept but a strict
    parser does not: arrays, scalars, a tail or a second object after the
    first. Inside brackets such a reply is no array of exactly one value. (A
    bare NaN or Infinity, which a standard JSON parser takes, is read as the
    text of that name.)"""
    clean = F.replace(T.col(reply), F.lit("\n"), F.lit(""))

    def strict(text: F.Column) -> F.Column:
        parsed = F.from_json(text, REPLY_MAP, {"allowSingleQuotes": "false"})
        single = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
        return F.when(text.rlike(T.JSON_OBJECT_SHAPE) & single, parsed)

    return F.coalesce(strict(clean), strict(F.regexp_replace(clean, BARE_NUMBER, '$1"$2"')))


def last_value(m, key: str) -> F.Column:
    """Value of ``key`` in a parsed reply; when the reply repeats a key the
    last one wins, as in a standard JSON parser."""
    hits = F.filter(F.map_entries(T.col(m)), lambda e: e["key"] == F.lit(key))
    return F.try_element_at(hits, F.lit(-1))["value"]


def parse_replies(df: DataFrame, reply: str = "response") -> DataFrame:
    """Adds ``parsed`` (bool), the five answer columns ('' when a key is
    missing), ``extra_keys`` (other keys, sorted, comma-joined) and
    ``confidence_int``. Keys of the reply never overwrite other columns."""
    m = reply_map(reply)
    out = df.withColumn("_m", m)
    cols = [F.coalesce(last_value("_m", k), F.lit("")).alias(c)
            for k, c in zip(ANSWER_KEYS, ANSWER_COLS)]
    extra = F.array_join(F.array_sort(F.filter(F.array_distinct(F.map_keys("_m")),
                                               lambda k: ~k.isin(*ANSWER_KEYS))), ",")
    return out.select(
        *df.columns, F.col("_m").isNotNull().alias("parsed"), *cols,
        extra.alias("extra_keys"),
    ).withColumn("confidence_int", F.col("confidence").try_cast("int"))


def null_answer_tokens(df: DataFrame, cols=FOUR_FIELDS) -> DataFrame:
    """N/A-style answers -> null."""
    return df.select(*[T.null_tokens(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def has_output(cols=FOUR_FIELDS) -> F.Column:
    """True when at least one answer field is non-null."""
    return F.greatest(*[F.col(c).isNotNull() for c in cols])


def birth_year(reply) -> F.Column:
    """Birth year from a free-text reply: a stated year, else the
    graduation year minus 22, else null."""
    r = T.col(reply)
    born = F.nullif(F.regexp_extract(r, BORN_YEAR, 1), F.lit(""))
    grad = F.nullif(F.regexp_extract(r, GRAD_YEAR, 1), F.lit(""))
    return F.coalesce(born.try_cast("int"), grad.try_cast("int") - GRADUATION_AGE)
