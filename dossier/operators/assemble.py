"""Excerpts, per-entity context and prompts (U-2, A-1, P-4..P-7, R-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.functions import text as T
from dossier.operators.corpus import as_corpus

# --- fixed values that must equal the reference ------------------------------
# Extraction prompt, written with single spaces between words.
EXTRACT_HEAD = ("Extract ONLY the College Major, Undergraduate Institution, Highest Degree "
                "and Institution, and Work History of ")
EXTRACT_AFTER_NAME = ", a state representative candidate from "
EXTRACT_BEFORE_TEXT = ", from the following text: "
EXTRACT_AFTER_TEXT = (". If any desired information is not present in the given text, write "
                      "N/A instead. Determine your confidence that the information you "
                      "previously extracted correctly describes ")
EXTRACT_BEFORE_YEAR = ", a "
EXTRACT_AFTER_YEAR = " state representative candidate from "
EXTRACT_TAIL = (", on a scale of 1 to 100. Display the college major, undergraduate "
                "institution, highest degree and institution, work history, and your "
                "confidence level as 5 elements of a JSON object.")
# Birth-year prompt.
BIRTH_HEAD = "Print a value indicating the year of birth of "
BIRTH_AFTER_NAME = ", a state representative candidate from "
BIRTH_TAIL = (". If the year of birth is present, print only the year as a number. If "
              "the year of undergraduate graduation is present, subtract 22 from that "
              "year and print that. No full sentences. If the information is not "
              "present, print N/A, and nothing else: ")
# Prompt limit of the model, in tokens.
PROMPT_TOKEN_LIMIT = 4096
# --- end of fixed values -------------------------------------------------------


def _s(c) -> F.Column:
    """String value, null printed as empty."""
    return F.coalesce(T.col(c).cast("string"), F.lit(""))


def query_text(full, state) -> F.Column:
    """Search text: the title-cased full name and the state."""
    return F.concat_ws(" ", T.title_case(full), T.col(state))


def extraction_prompt(full, state, min_year, context, repeat_context: bool = True) -> F.Column:
    """The extraction prompt. With ``repeat_context`` the excerpt is appended
    once more after the instructions, as the reference sends it."""
    name = _s(T.title_case(full))
    p = F.concat(F.lit(EXTRACT_HEAD), name, F.lit(EXTRACT_AFTER_NAME), _s(state),
                 F.lit(EXTRACT_BEFORE_TEXT), _s(context), F.lit(EXTRACT_AFTER_TEXT), name,
                 F.lit(EXTRACT_BEFORE_YEAR), _s(min_year), F.lit(EXTRACT_AFTER_YEAR), _s(state),
                 F.lit(EXTRACT_TAIL))
    return F.concat(p, F.lit(" "), _s(context)) if repeat_context else p


def birth_year_prompt(full_name, state, excerpt) -> F.Column:
    return F.concat(F.lit(BIRTH_HEAD), _s(full_name), F.lit(BIRTH_AFTER_NAME), _s(state),
                    F.lit(BIRTH_TAIL), _s(excerpt))


def over_budget(prompt, limit: int = PROMPT_TOKEN_LIMIT) -> F.Column:
    """True when the estimated token count exceeds the model's limit."""
    return T.estimated_tokens(prompt) > F.lit(limit)


def linked_text(links: DataFrame, entities: DataFrame, corpus,
                key: str = "candid") -> DataFrame:
    """Linked (entity, source) pairs with the source text and the entity's
    name parts. ``links`` (key, page_id, url, rank) has r rows per entity;
    the corpus is filtered to linked documents map-side, their text is
    computed once each, and a document linked by very many entities is
    split over several copies (``Corpus.text_for``). Entities that share a
    key are linked once; ``with_context`` gives each its own row again."""
    names = entities.select(key, "first", "middle", "last").dropDuplicates([key])
    pairs = links.select(key, "page_id", "url", "rank").join(names, key)
    return as_corpus(corpus).text_for(pairs)


def source_excerpts(links: DataFrame, entities: DataFrame, corpus,
                    key: str = "candid") -> DataFrame:
    """One row per linked (entity, source): the cascade excerpt of the
    source text and the name level it is anchored on."""
    return linked_text(links, entities, corpus, key).select(
        key, "rank", "page_id", "url",
        T.cascade_level("text", "last", "first", "middle").alias("level"),
        T.cascade_excerpt("text", "last", "first", "middle").alias("excerpt"),
    )


def assemble_context(excerpts: DataFrame, key: str = "candid") -> DataFrame:
    """Per entity: excerpts joined by one space in rank order (empty ones
    included) and the ordered source list. Groups hold at most r rows."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "excerpt", "url")))
    return excerpts.groupBy(key).agg(
        F.array_join(F.transform(ordered, lambda s: s["excerpt"]), " ").alias("context"),
        F.transform(ordered, lambda s: s["url"]).alias("sources"),
    )


def with_context(entities: DataFrame, contexts: DataFrame, key: str = "candid") -> DataFrame:
    """Left join back, so entities without any source stay (context '')."""
    return (entities.join(contexts, key, "left")
            .withColumn("context", F.coalesce("context", F.lit("")))
            .withColumn("sources", F.coalesce("sources", F.array().cast("array<string>"))))
