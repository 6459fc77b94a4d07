"""Text, linking and excerpt query bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.functions import text as T
from dossier.operators import assemble as A
from dossier.operators import link as L
from dossier.operators.joins import checked_broadcast
from dossier.operators.segments import first_k_segments
from dossier.plans import oracle as O
from dossier.plans import views as V
from dossier.plans.catalog import register, sources_text
from dossier.plans.profiles import gather_contexts
from dossier.session import materialize

ALT_STOP_WORD = "und"

# the page linking run as CTEs: text_entities, corpus, links, excerpts, contexts, prompts
PIPE = O.with_(O.TEXT_ENTITIES, O.PAGE_CORPUS, O.links_overlap(4), O.EXCERPTS, O.CONTEXTS, f"""prompts AS (
  SELECT e.*, coalesce(c.context, '') AS context, coalesce(c.sources, '') AS sources,
         {O.extraction_prompt('e."full"', 'e.state', 'e.min_year', "coalesce(c.context, '')")} AS prompt
  FROM text_entities e LEFT JOIN contexts c ON e.candid = c.candid)""")


def page_prompts(spark, sf_dir):
    return gather_contexts(V.text_entities(spark, sf_dir), V.page_corpus(spark, sf_dir), r=4)


def _links(spark, sf_dir, corpus):
    return L.link_overlap(V.text_entities(spark, sf_dir), corpus, r=4)


LINK_COLS = ("candid", "rank", "page_id", "url", "score")


@register("html_to_text", O.with_(O.PAGE_CORPUS) + "SELECT page_id, url, text FROM corpus")
def q_html_to_text(spark, sf_dir):
    return V.page_corpus(spark, sf_dir).texts()


@register("link_top_r", O.with_(O.TEXT_ENTITIES, O.PAGE_CORPUS, O.links_overlap(4))
          + "SELECT candid, rank, page_id, url, score FROM links")
def q_link_top_r(spark, sf_dir):
    return _links(spark, sf_dir, V.page_corpus(spark, sf_dir)).select(*LINK_COLS)


@register("link_bm25", O.with_(O.TEXT_ENTITIES, O.PAGE_CORPUS, O.links_bm25(4))
          + "SELECT candid, rank, page_id, url, round(score, 6) AS score FROM links")
def q_link_bm25(spark, sf_dir):
    out = L.link_bm25(V.text_entities(spark, sf_dir), V.page_corpus(spark, sf_dir), r=4, state="state")
    return out.select("candid", "rank", "page_id", "url", F.round("score", 6).alias("score"))


@register("link_filtered", O.with_(O.TEXT_ENTITIES, O.EN_US_PAGES, O.links_overlap(4))
          + "SELECT candid, rank, page_id, url, score FROM links")
def q_link_filtered(spark, sf_dir):
    return _links(spark, sf_dir, V.filtered_pages(spark, sf_dir)).select(*LINK_COLS)


@register("contains_cascade", O.with_(O.TEXT_ENTITIES, O.PAGE_CORPUS, O.links_overlap(4), O.EXCERPTS)
          + "SELECT candid, rank, page_id, level, excerpt FROM excerpts")
def q_contains_cascade(spark, sf_dir):
    corpus = V.page_corpus(spark, sf_dir)
    ents = V.text_entities(spark, sf_dir)
    links = materialize(L.link_overlap(ents, corpus, r=4))
    return A.source_excerpts(links, ents, corpus).select("candid", "rank", "page_id", "level", "excerpt")


def _doc_excerpt_sql(stop_word):
    return (O.with_(O.TEXT_ENTITIES, O.DOC_CORPUS, O.links_overlap(4), O.EXCERPTS)
            + f"SELECT candid, rank, page_id, {O.excerpt('text', 'last', stop_word=stop_word)} AS excerpt "
              "FROM excerpts")


def _doc_excerpts(spark, sf_dir, stop_word):
    corpus = V.doc_corpus(spark, sf_dir)
    ents = V.text_entities(spark, sf_dir)
    links = materialize(L.link_overlap(ents, corpus, r=4))
    return A.linked_text(links, ents, corpus).select(
        "candid", "rank", "page_id",
        T.keyword_excerpt("text", "last", stop_word=stop_word).alias("excerpt"))


@register("keyword_excerpt", _doc_excerpt_sql(T.STOP_WORD))
def q_keyword_excerpt(spark, sf_dir):
    return _doc_excerpts(spark, sf_dir, T.STOP_WORD)


@register("excerpt_stop_word", _doc_excerpt_sql(ALT_STOP_WORD))
def q_excerpt_stop_word(spark, sf_dir):
    return _doc_excerpts(spark, sf_dir, ALT_STOP_WORD)


@register("assemble_excerpts", O.with_(O.TEXT_ENTITIES, O.DOC_CORPUS, O.links_overlap(4), O.EXCERPTS,
                                        O.CONTEXTS) + """
SELECT e.candid, coalesce(c.sources, '') AS sources, coalesce(c.context, '') AS context
FROM text_entities e LEFT JOIN contexts c ON e.candid = c.candid""")
def q_assemble_excerpts(spark, sf_dir):
    out = gather_contexts(V.text_entities(spark, sf_dir), V.doc_corpus(spark, sf_dir), r=4)
    return out.select("candid", sources_text().alias("sources"), "context")


@register("explode_sources", PIPE + """,
src AS (SELECT candid, string_split(sources, '|') AS s FROM prompts WHERE sources <> '')
SELECT candid, CAST(pos - 1 AS INTEGER) AS pos, s[pos] AS url
FROM src, range(1, len(s) + 1) t(pos)""")
def q_explode_sources(spark, sf_dir):
    out = page_prompts(spark, sf_dir)
    return (out.select("candid", F.posexplode_outer("sources").alias("pos", "url"))
            .filter(F.col("url").isNotNull()))


@register("link_pages_by_url", PIPE + """,
src AS (SELECT candid, string_split(sources, '|') AS s FROM prompts WHERE sources <> ''),
ex AS (SELECT candid, CAST(pos - 1 AS INTEGER) AS pos, s[pos] AS url FROM src, range(1, len(s) + 1) t(pos))
SELECT ex.candid, ex.pos, ex.url, p.page_id, CAST(length(p.html) AS INTEGER) AS html_chars
FROM ex LEFT JOIN pages p ON ex.url = p.url""")
def q_link_pages_by_url(spark, sf_dir):
    out = page_prompts(spark, sf_dir)
    ex = (out.select("candid", F.posexplode_outer("sources").alias("pos", "url"))
          .filter(F.col("url").isNotNull()))
    # the page table is cut to the linked URLs map-side (a broadcast of the
    # distinct linked URLs, after a count), so it is never shuffled whole
    urls = checked_broadcast(ex.select("url").distinct())
    pages = (V.table(spark, sf_dir, "pages").join(urls, "url", "left_semi")
             .select("url", "page_id", F.length("html").alias("html_chars")))
    return ex.join(pages, "url", "left").select("candid", "pos", "url", "page_id", "html_chars")


@register("first_k_segments", """
SELECT conv_id AS doc_id, string_agg(text, ' ' ORDER BY turn) AS text, count(*) AS segments
FROM conversations WHERE turn < 3 GROUP BY conv_id""")
def q_first_k_segments(spark, sf_dir):
    out = first_k_segments(V.segments(spark, sf_dir), k=3)
    return out.select("doc_id", "text", F.col("segments").cast("bigint").alias("segments"))


@register("classify_source", """
SELECT page_id, url, CASE WHEN contains(url, '.pdf') THEN 'pdf' ELSE 'html' END AS kind FROM pages""")
def q_classify_source(spark, sf_dir):
    p = V.table(spark, sf_dir, "pages")
    return p.select("page_id", "url", F.when(T.is_pdf("url"), "pdf").otherwise("html").alias("kind"))


_LIT_SQL = f"'[''' || url || ''', ''' || regexp_extract(url, {O.q(V.URL_HOST)}, 1) || ''']'"


@register("parse_list_literal", f"""
WITH lit AS (SELECT page_id, {_LIT_SQL} AS literal FROM pages),
parsed AS (SELECT page_id, literal,
  list_transform(string_split(substr(literal, 2, length(literal) - 2), ','),
                 lambda s: replace({O.strip('s')}, '''', '')) AS items FROM lit)
SELECT page_id, literal, array_to_string(items, '|') AS items, CAST(len(items) AS INTEGER) AS n_items FROM parsed""")
def q_parse_list_literal(spark, sf_dir):
    p = V.table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", V.URL_HOST, 1)
    lit = F.concat(F.lit("['"), F.col("url"), F.lit("', '"), host, F.lit("']"))
    items = T.parse_list_literal("literal")
    return (p.select("page_id", lit.alias("literal"))
            .select("page_id", "literal", F.array_join(items, "|").alias("items"),
                    F.size(items).alias("n_items")))


@register("build_prompt", PIPE + f"""
SELECT candid, {O.extraction_prompt('"full"', 'state', 'min_year', 'context', repeat_context=False)} AS prompt
FROM prompts""")
def q_build_prompt(spark, sf_dir):
    out = page_prompts(spark, sf_dir)
    return out.select("candid", A.extraction_prompt("full", "state", "min_year", "context",
                                                    repeat_context=False).alias("prompt"))


@register("recover_excerpt", PIPE + f"""
SELECT candid, {O.recover_excerpt('prompt')} AS excerpt FROM prompts""")
def q_recover_excerpt(spark, sf_dir):
    return page_prompts(spark, sf_dir).select("candid", T.recover_excerpt("prompt").alias("excerpt"))


@register("birth_year_prompt", PIPE + f"""
SELECT candid, {O.birth_year_prompt('"full"', 'state', O.recover_excerpt('prompt'))} AS prompt FROM prompts""")
def q_birth_year_prompt(spark, sf_dir):
    out = page_prompts(spark, sf_dir)
    return out.select("candid", A.birth_year_prompt("full", "state", T.recover_excerpt("prompt")).alias("prompt"))


@register("prompt_budget", PIPE + f"""
SELECT candid, {O.estimated_tokens('prompt')} AS est_tokens,
       CASE WHEN {O.estimated_tokens('prompt')} > {A.PROMPT_TOKEN_LIMIT} THEN 'prompt' ELSE 'ok' END AS route
FROM prompts""")
def q_prompt_budget(spark, sf_dir):
    out = page_prompts(spark, sf_dir)
    return out.select("candid", T.estimated_tokens("prompt").alias("est_tokens"),
                      F.when(A.over_budget("prompt"), "prompt").otherwise("ok").alias("route"))
