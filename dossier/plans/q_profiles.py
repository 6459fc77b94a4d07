"""Profile-level queries (minimum slice and whole runs)."""

from __future__ import annotations

from dossier.plans import oracle as O
from dossier.plans import views as V
from dossier.plans.catalog import register, sources_text
from dossier.plans.profiles import gather_contexts

_SAMPLE_SQL = O.with_(O.TEXT_ENTITIES, O.PAGE_CORPUS, O.links_overlap(4), O.EXCERPTS, O.CONTEXTS) + f"""
SELECT e.candid, e."full", e.state, e.min_year,
       coalesce(c.sources, '') AS sources, coalesce(c.context, '') AS context,
       {O.extraction_prompt('e."full"', 'e.state', 'e.min_year', "coalesce(c.context, '')")} AS prompt
FROM text_entities e LEFT JOIN contexts c ON e.candid = c.candid"""


@register("profile_sample", _SAMPLE_SQL)
def profile_sample(spark, sf_dir):
    """Every entity, its top-4 sources by term overlap, the cascade excerpts
    joined in rank order, and the extraction prompt."""
    out = gather_contexts(V.text_entities(spark, sf_dir), V.page_corpus(spark, sf_dir), r=4)
    return out.select("candid", "full", "state", "min_year",
                      sources_text().alias("sources"), "context", "prompt")
