"""Whole-run plans: link entities to sources, cut excerpts, assemble
one context and prompt per entity (SURVEY §3.1 steps 2-9 as one lazy plan)."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame

from dossier.operators import assemble as A
from dossier.operators import link as L
from dossier.operators.corpus import as_corpus
from dossier.session import materialize


def gather_contexts(entities: DataFrame, corpus, r: int = 4,
                    ranker: str = "overlap", key: str = "candid",
                    repeat_context: bool = True) -> DataFrame:
    """entities (key, first, middle, last, full, state, min_year) + corpus
    (a Corpus, or a (page_id, url, text) table) -> one row per entity with its ordered sources,
    the joined excerpts (context) and the extraction prompt.

    The link table is materialised once (it is the stage hand-off of the
    reference, and the broadcast check below counts it cheaply)."""
    link_fn = {"overlap": L.link_overlap, "bm25": functools.partial(L.link_bm25, state="state")}[ranker]
    corpus = as_corpus(corpus).staged()
    links = materialize(link_fn(entities, corpus, r=r, key=key))
    ex = A.source_excerpts(links, entities, corpus, key=key)
    ctx = A.assemble_context(ex, key=key)
    out = A.with_context(entities, ctx, key=key)
    return out.withColumn(
        "prompt", A.extraction_prompt("full", "state", "min_year", "context",
                                      repeat_context=repeat_context))
