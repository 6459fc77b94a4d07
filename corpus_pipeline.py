"""The training-data run over ``documents``: quality rules, line dedup,
near-dedup, decontamination, packing. Part of the subpackage ``dossier.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept, written as Parquet and read again. All but the last return the columns of
``documents``; a row rejected, copied or contaminated is gone for the stages
after it, and later copies of line runs are cut out of the texts.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm import decontaminate, linededup, packing, rules, simhash
from dossier.llm.base import stage, table
from dossier.session import collected_paths, delete_path

#: Tables that the stage before has staged for itself.
_LEFT: list[str] = []


def releasing(step: Callable) -> Callable:
    """When a stage begins, the result of the one before has been written and
    read again: what that stage staged on the way is deleted."""
    @functools.wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _LEFT:
            delete_path(spark, _LEFT.pop())
        with collected_paths(_LEFT):
            return step(spark, docs, sf_dir)
    return run


@releasing
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep."""
    return rules.filtered(docs, table(spark, sf_dir, "labels"))


@releasing
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of line runs of 50 words or more."""
    out = linededup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@releasing
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each near-duplicate group."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


@releasing
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


@releasing
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, with their place in a sequence."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]

#: Fingerprints, the forest and the tokenizer have no SQL; tests hold the run
#: against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
