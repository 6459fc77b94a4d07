"""DuckDB SQL fragments for the oracle check.

Each helper renders the same rule as its Spark counterpart from the same
constants (patterns, templates, dictionaries), so the two cannot drift."""

from __future__ import annotations

from dossier.functions import text as T
from dossier.functions.states import STATES
from dossier.operators import assemble as A
from dossier.plans.views import SAB_BY_NATION


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def s_or_empty(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(T.EDGE_SPACE)}, '', 'g')"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), {q(T.TITLE_PIECES)}, 1), "
            f"lambda t: replace(upper(substr(t, 1, 1)), 'ẞ', 'Ss') || substr(t, 2)), '')")


def html_to_text(x: str) -> str:
    t = x
    for pattern in T.HTML_MARKUP:
        t = f"regexp_replace({t}, {q(pattern)}, ' ', 'g')"
    names = ", ".join(f"{q(k)}: {v}" for k, v in T.entity_codes().items())
    name = f"regexp_extract(p, {q(T.ENTITY)}, 1)"
    code = (f"CASE WHEN starts_with(lower({name}), '#x') THEN TRY_CAST('0x' || substr({name}, 3) AS INTEGER) "
            f"WHEN starts_with({name}, '#') THEN TRY_CAST(substr({name}, 2) AS INTEGER) ELSE MAP {{{names}}}[{name}] END")
    real = f"coalesce({code} > 0 AND {code} < 1114112 AND NOT {code} BETWEEN 55296 AND 57343, false)"
    part = f"CASE WHEN {real} THEN chr({code}) || substr(p, length({name}) + 2) ELSE '&' || p END"
    decoded = (f"(list_transform([string_split({t}, '&')], lambda s: s[1] || "
               f"array_to_string(list_transform(s[2:], lambda p: {part}), '')))[1]")
    return f"lower({strip(f"regexp_replace({decoded}, {q(T.SPACE + '+')}, ' ', 'g')")})"


def source_text(url: str, body: str) -> str:
    pages = f"lower(array_to_string(string_split({body}, chr(12))[1:{T.FIRST_PAGES}], ' '))"
    return f"CASE WHEN contains({url}, '.pdf') THEN {pages} ELSE {html_to_text(body)} END"


def letter_terms(x: str) -> str:
    return f"regexp_extract_all({x}, {q(T.LETTER_RUN)})"


def states_case(code: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in STATES.items())
    return f"(CASE {code} {whens} ELSE NULL END)"


def decode_state(x: str) -> str:
    code = strip(x)
    return f"coalesce({states_case(code)}, {code})"


def sab_for(key: str) -> str:
    arr = "[" + ", ".join(q(c) for c in SAB_BY_NATION) + "]"
    return f"({arr})[CAST(({key} % {len(SAB_BY_NATION)} + {len(SAB_BY_NATION)}) % {len(SAB_BY_NATION)} + 1 AS INTEGER)]"


def excerpt(text: str, phrase: str, max_words: int = T.MAX_WORDS,
            stop_word: str | None = T.STOP_WORD) -> str:
    hit = f"({phrase} IS NOT NULL AND {phrase} <> '' AND {text} IS NOT NULL AND strpos({text}, {phrase}) > 0)"
    words = f"string_split(regexp_replace(substr({text}, strpos({text}, {phrase})), {q(T.NEWLINE_SPACE)}, ' ', 'g'), ' ')"
    if stop_word:
        body = (f"(lambda w: array_to_string(w[1:CASE WHEN coalesce(list_position(w[1:{max_words}], {q(stop_word)}), 0) > 0 "
                f"THEN list_position(w[1:{max_words}], {q(stop_word)}) ELSE {max_words} END], ' '))")
    else:
        body = f"(lambda w: array_to_string(w[1:{max_words}], ' '))"
    # apply the lambda to the word list via list_transform on a one-element list
    return (f"(CASE WHEN {hit} THEN (list_transform([{words}], {body[1:-1]}))[1] ELSE '' END)")


def cascade_excerpt(text: str, last: str, first: str, middle: str) -> str:
    lv = [f"nullif({excerpt(text, p)}, '')" for p in (last, first, middle)]
    return f"coalesce({', '.join(lv)}, '')"


def cascade_level(text: str, last: str, first: str, middle: str) -> str:
    def found(p):
        return f"({p} IS NOT NULL AND {p} <> '' AND strpos({text}, {p}) > 0)"
    return (f"(CASE WHEN {found(last)} THEN 'last' WHEN {found(first)} THEN 'first' "
            f"WHEN {found(middle)} THEN 'middle' ELSE 'none' END)")


def extraction_prompt(full: str, state: str, min_year: str, context: str,
                      repeat_context: bool = True) -> str:
    name = s_or_empty(title_case(full))
    parts = [q(A.EXTRACT_HEAD), name, q(A.EXTRACT_AFTER_NAME), s_or_empty(state),
             q(A.EXTRACT_BEFORE_TEXT), s_or_empty(context), q(A.EXTRACT_AFTER_TEXT), name,
             q(A.EXTRACT_BEFORE_YEAR), s_or_empty(min_year), q(A.EXTRACT_AFTER_YEAR),
             s_or_empty(state), q(A.EXTRACT_TAIL)]
    if repeat_context:
        parts += ["' '", s_or_empty(context)]
    return "(" + " || ".join(parts) + ")"


def birth_year_prompt(full_name: str, state: str, ex: str) -> str:
    parts = [q(A.BIRTH_HEAD), s_or_empty(full_name), q(A.BIRTH_AFTER_NAME),
             s_or_empty(state), q(A.BIRTH_TAIL), s_or_empty(ex)]
    return "(" + " || ".join(parts) + ")"


def recover_excerpt(prompt: str) -> str:
    return (f"(string_split((string_split({prompt}, {q(T.PROMPT_TEXT_MARKER)}))[-1], "
            f"{q(T.PROMPT_TAIL_MARKER)}))[1]")


def null_tokens(x: str) -> str:
    toks = ", ".join(q(t) for t in T.NULL_TOKENS)
    return f"(CASE WHEN {strip(x)} IN ({toks}) THEN NULL ELSE {x} END)"


def estimated_tokens(x: str) -> str:
    return f"CAST(ceil(length({x}) / 4.0) AS BIGINT)"


# --- derived views as CTE bodies ---------------------------------------------

ENTITIES = f"""entities AS (
  SELECT c.c_custkey AS "row", CAST(c.c_custkey AS VARCHAR) AS candid,
         c.c_mktsegment AS first,
         CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE 'm' || CAST(c.c_custkey % 7 AS VARCHAR) END AS middle,
         n.n_name AS last,
         CASE WHEN c.c_custkey % 11 = 0 THEN 'jr' ELSE NULL END AS suffix,
         CAST(1967 + c.c_custkey % 51 AS INTEGER) AS min_year,
         {sab_for('n.n_nationkey')} AS sab
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

def first_words(x: str, n: int = 3) -> list[str]:
    pat = q(T.first_words_pattern(n))
    return [f"nullif(regexp_extract({x}, {pat}, {i}), '')" for i in range(1, n + 1)]


_W = first_words("lower(text)", 4)
TEXT_ENTITIES = f"""name_words AS (
  SELECT item_id, {_W[0]} AS w1, {_W[1]} AS w2, {_W[2]} AS w3, {_W[3]} AS w4 FROM benchmark),
names AS (
  SELECT item_id,
         CASE item_id % 4 WHEN 1 THEN w1 || ' ' || w2 WHEN 3 THEN upper(w1) ELSE w1 END AS first,
         CASE item_id % 4 WHEN 1 THEN w3 WHEN 3 THEN w2 || chr(39) || w3 ELSE w2 END AS middle,
         CASE item_id % 4 WHEN 2 THEN w3 || '-' || w4 WHEN 0 THEN w3 ELSE w4 END AS last FROM name_words),
text_entities AS (
  SELECT item_id AS "row", CAST(item_id AS VARCHAR) AS candid, first, middle, last,
         concat_ws(' ', first, middle, last) AS "full",
         CAST(1967 + item_id % 51 AS INTEGER) AS min_year,
         {decode_state(sab_for('item_id'))} AS state
  FROM names)"""

PAGE_CORPUS = f"""corpus AS (
  SELECT page_id, url, {source_text('url', 'html')} AS text FROM pages)"""

DOC_CORPUS = """corpus AS (
  SELECT doc_id AS page_id, 'doc://' || source || '/' || CAST(doc_id AS VARCHAR) AS url,
         lower(text) AS text FROM documents)"""

EN_US_PAGES = f"""corpus AS (
  SELECT page_id, url, {source_text('url', 'html')} AS text FROM pages
  WHERE regexp_extract(html, '<html[^>]*\\blang="([^"]*)"', 1) = 'en'
    AND ends_with(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '.com'))"""


def _matched(ents: str, corpus: str, state: str = "NULL") -> str:
    """Every document that holds all words of some part of an entity's name, or
    of its state, which is weak unless a name part has the same words."""
    return f"""docs AS (SELECT page_id, url, regexp_extract_all(text, '\\p{{L}}+') AS terms FROM {corpus}),
parts AS (
  SELECT candid, words, min(weak) AS weak FROM (
    SELECT candid, weak, list_sort(list_distinct(regexp_extract_all(lower(part), '\\p{{L}}+'))) AS words
    FROM (SELECT candid, unnest([first, middle, last]) AS part, 0 AS weak FROM {ents}
          UNION ALL SELECT candid, {state}, 1 FROM {ents}) WHERE part IS NOT NULL) WHERE len(words) > 0 GROUP BY candid, words),
heads AS (SELECT DISTINCT page_id, unnest(terms) AS head FROM docs),
matched AS (
  SELECT p.candid, d.page_id, d.url, p.words, p.weak
  FROM parts p JOIN heads h ON h.head = p.words[1] JOIN docs d ON d.page_id = h.page_id
  WHERE list_has_all(d.terms, p.words))"""


def _ranked(r: int) -> str:
    return f"""links AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY candid ORDER BY score DESC, page_id) AS INTEGER) AS rank FROM scored)
  WHERE rank <= {r})"""


def links_overlap(r: int = 4, ents: str = "text_entities", corpus: str = "corpus") -> str:
    return f"""{_matched(ents, corpus)},
scored AS (SELECT candid, page_id, url, count(*) AS score FROM matched GROUP BY candid, page_id, url),
{_ranked(r)}"""


def links_bm25(r: int = 4, ents: str = "text_entities", corpus: str = "corpus",
               k1: float = 1.2, b: float = 0.75, state_weight: float = 0.5) -> str:
    return f"""{_matched(ents, corpus, "state")},
stats AS (SELECT count(*) AS n, avg(len(terms)) AS avgdl FROM docs),
tf AS (
  SELECT page_id, dl, term, count(*) AS tf FROM (SELECT page_id, len(terms) AS dl, unnest(terms) AS term FROM docs)
  GROUP BY page_id, dl, term),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
hit AS (SELECT candid, page_id, url, term, CASE WHEN min(weak) = 1 THEN {state_weight} ELSE 1.0 END AS f
        FROM (SELECT candid, page_id, url, weak, unnest(words) AS term FROM matched) GROUP BY candid, page_id, url, term),
scored AS (
  SELECT h.candid, tf.page_id, h.url,
         round(sum(h.f * ln(1.0 + (s.n - dfs.df + 0.5) / (dfs.df + 0.5)) * tf.tf * {k1 + 1.0}
                   / (tf.tf + {k1} * ({1.0 - b} + {b} * tf.dl / s.avgdl))), 9) AS score
  FROM hit h JOIN tf USING (page_id, term) JOIN dfs USING (term), stats s
  GROUP BY h.candid, tf.page_id, h.url),
{_ranked(r)}"""


def excerpts(corpus: str = "corpus", ents: str = "text_entities") -> str:
    return f"""excerpts AS (
  SELECT l.candid, l.rank, l.page_id, l.url, l.score,
         {cascade_level('c.text', 'e.last', 'e.first', 'e.middle')} AS level,
         {cascade_excerpt('c.text', 'e.last', 'e.first', 'e.middle')} AS excerpt,
         c.text AS text, e.last AS last
  FROM links l JOIN {ents} e ON l.candid = e.candid JOIN {corpus} c ON l.page_id = c.page_id)"""


EXCERPTS = excerpts()

CONTEXTS = """contexts AS (
  SELECT candid, string_agg(excerpt, ' ' ORDER BY rank) AS context,
         string_agg(url, '|' ORDER BY rank) AS sources
  FROM excerpts GROUP BY candid)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _reply_sql() -> str:
    from dossier.plans.views import REPLY_COLUMNS, REPLY_VARIANTS
    whens = []
    for i, parts in enumerate(REPLY_VARIANTS):
        body = " || ".join(x if x in REPLY_COLUMNS else q(x).replace("\n", "' || chr(10) || '")
                           for x in parts)
        whens.append(f"WHEN {i} THEN {body}")
    return f"CASE doc_id % {len(REPLY_VARIANTS)} " + " ".join(whens) + " END"


REPLIES = f"""reply_parts AS (
  SELECT doc_id, source, lang, n_chars,
         coalesce({_W[0]}, '') AS w1, coalesce({_W[1]}, '') AS w2, coalesce({_W[2]}, '') AS w3,
         CAST(n_chars % 100 AS VARCHAR) AS conf,
         substr(CAST(to_json(coalesce(text, '')) AS VARCHAR), 2, length(CAST(to_json(coalesce(text, '')) AS VARCHAR)) - 2) AS whole
  FROM documents),
replies AS (
  SELECT CAST(doc_id AS VARCHAR) AS candid, doc_id AS "row", concat_ws(' ', w1, w2) AS name,
         {decode_state(sab_for('doc_id'))} AS state,
         CAST(1967 + doc_id % 51 AS INTEGER) AS min_year,
         'doc://' || source || '/' || CAST(doc_id AS VARCHAR) AS sources,
         lang, source, n_chars,
         {_reply_sql()} AS response
  FROM reply_parts)"""


def parsed_cols(reply: str = "response") -> str:
    """SELECT-list items that parse ``reply`` like dossier.operators.parse."""
    from dossier.operators.parse import ANSWER_COLS, ANSWER_KEYS
    clean = f"replace({reply}, chr(10), '')"
    ok = (f"(regexp_matches({clean}, {q(T.JSON_OBJECT_SHAPE)}) AND CASE WHEN json_valid({clean}) "
          f"THEN json_type(({clean})::JSON) = 'OBJECT' ELSE false END)")
    items = [f"{ok} AS parsed"]
    for k, c in zip(ANSWER_KEYS, ANSWER_COLS):
        items.append(f"CASE WHEN {ok} THEN coalesce(json_extract_string({clean}, {q('$.' + chr(34) + k + chr(34))}), '') "
                     f"ELSE '' END AS {c}")
    keys = ", ".join(q(k) for k in ANSWER_KEYS)
    items.append(f"CASE WHEN {ok} THEN array_to_string(list_sort(list_filter(json_keys(CASE WHEN {ok} THEN ({clean})::JSON END), "
                 f"lambda k: k NOT IN ({keys}))), ',') ELSE NULL END AS extra_keys")
    return ",\n  ".join(items)
