"""CSV at the edges (S-1, S-4, S-5, S-7, K-1, K-2, K-9, U-A, U-A2).
Inside a run every hand-off is Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from dossier.functions import text as T
from dossier.sources.csv_splits import read_splits

# Options that keep any text intact: standard double-quote quoting and
# escaping, multi-line records, no trimming of leading/trailing spaces, and
# null written as \N so that it stays apart from the empty string.
CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
}

ENTITY_SOURCE_SCHEMA = TY.StructType([
    TY.StructField("row", TY.LongType()), TY.StructField("first", TY.StringType()),
    TY.StructField("middle", TY.StringType()), TY.StructField("last", TY.StringType()),
    TY.StructField("suffix", TY.StringType()), TY.StructField("min_year", TY.IntegerType()),
    TY.StructField("sab", TY.StringType()), TY.StructField("candid", TY.StringType()),
])

# --- fixed values that must equal the reference ------------------------------
# Column headers of the stored prompt table, "regular" and "condensed".
PROMPT_HEADERS_REGULAR = ("ChatGPT Prompt", "Sources", "Full Name", "Min Year", "State", "Candid")
PROMPT_HEADERS_CONDENSED = ("chatgptprompt", "sources", "fullname", "minyear", "state", "candid")
# --- end of fixed values -------------------------------------------------------
PROMPT_COLUMNS = ("prompt", "sources", "full_name", "min_year", "state", "candid")
HEADER_VARIANTS = {"regular": PROMPT_HEADERS_REGULAR, "condensed": PROMPT_HEADERS_CONDENSED}


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).option("encoding", encoding).csv(path)


def read_csv(spark: SparkSession, path: str, schema: TY.StructType | None = None,
             encoding: str = "UTF-8", split: bool = False) -> DataFrame:
    """Read with a declared schema (no inference). Without one, every
    column is a string and must be cast by name by the caller. With ``split``
    a file is read by many tasks (``csv_splits``) instead of one."""
    if split:
        return read_splits(spark, [path], CSV_OPTIONS, encoding, schema)
    r = spark.read.options(**CSV_OPTIONS).option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", "false")
    return r.csv(path)


def read_entity_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """The entity source table; Latin-1 by default, as the source files are."""
    return read_csv(spark, path, ENTITY_SOURCE_SCHEMA, encoding)


def list_literal(c) -> F.Column:
    """Array -> Python-style list literal ``['a', 'b']`` (the import format)."""
    return F.concat(F.lit("["), F.array_join(F.transform(T.col(c), lambda s: F.concat(F.lit("'"), s, F.lit("'"))),
                                             ", "), F.lit("]"))


def write_prompt_table(df: DataFrame, path: str, variant: str = "regular") -> None:
    """Stored prompts as CSV with the given header variant; the source list
    is written as a list literal."""
    heads = HEADER_VARIANTS[variant]
    out = df.select(*[(list_literal(c) if c == "sources" else F.col(c)).alias(h)
                      for c, h in zip(PROMPT_COLUMNS, heads)])
    write_csv(out, path)


def read_prompt_table(spark: SparkSession, path: str, variant: str = "regular") -> DataFrame:
    """Read a stored prompt table in either header variant and rename the
    columns to ours (a rename map, then typed casts by name)."""
    if variant not in HEADER_VARIANTS:
        raise ValueError(f"variant must be one of {sorted(HEADER_VARIANTS)}")
    raw = read_csv(spark, path)
    df = raw.withColumnsRenamed(dict(zip(HEADER_VARIANTS[variant], PROMPT_COLUMNS)))
    return df.select(
        "candid", "full_name", F.col("min_year").try_cast("int").alias("min_year"), "state", "prompt",
        T.parse_list_literal("sources").alias("sources"))


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """File paths under a folder (recursively), via Spark's own file
    listing; only the paths are read, never the contents."""
    rows = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(folder).select("path").collect())
    return sorted(r["path"] for r in rows)


def list_shards(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Shards under a folder: a plain CSV file directly in it is one shard;
    a sub-folder written by one Spark job (part files sharing one header)
    is one shard."""
    top = folder.rstrip("/")
    shards = set()
    for p in list_files(spark, folder, pattern):
        parent = p.rsplit("/", 1)[0]
        shards.add(p if parent.endswith(top) else parent)
    return sorted(shards)


def union_shards(spark: SparkSession, paths: Sequence[str], schema: TY.StructType) -> DataFrame:
    """Concatenate CSV shards whose headers may differ in order or content:
    columns are matched by name (a plain glob read would align them by
    position), missing ones are null and duplicates are kept. One scan reads
    all files, large ones in several tasks."""
    if not paths:
        raise ValueError("no shard files")
    return read_splits(spark, paths, CSV_OPTIONS, schema=schema)


def write_family(df: DataFrame, path: str, keys: Sequence[str] = ("kind", "grp"),
                 mode: str = "overwrite") -> None:
    """Results of every family and group in one table, one folder per key
    value, so that reading one family/group prunes all other folders. Rows are
    dealt by their folder first, so a folder gets few files, not one of every
    task; AQE splits a folder that holds very many rows."""
    df.hint("rebalance", *[F.col(k) for k in keys]).write.mode(mode).partitionBy(*keys).parquet(path)


def read_family(spark: SparkSession, path: str, where: Mapping[str, str]) -> DataFrame:
    df = spark.read.parquet(path)
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    return df
