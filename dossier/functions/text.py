"""Column -> Column text functions. All are native Spark expressions, so they
run inside the JVM (regex calls are interpreted but never leave it); none
is a Python UDF.

Regex patterns stay in the subset that Java and RE2 read the same way, so
the DuckDB oracle can use the very same pattern strings (see
``dossier.plans.oracle``)."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference ------------------------------
# Word that ends an excerpt early when it occurs within the word budget.
STOP_WORD = "accessibility"
# Words kept per source excerpt.
MAX_WORDS = 400
# Pages read of a PDF source.
FIRST_PAGES = 3
# Markers around the excerpt inside a stored extraction prompt.
PROMPT_TEXT_MARKER = "text: "
PROMPT_TAIL_MARKER = "If any desired"
# --- end of fixed values -------------------------------------------------------

# Tokens read as "no value" (the CSV reader's default null markers that the
# reference relies on when it tests answers for null).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null")

LETTER_RUN = r"\p{L}+"
TITLE_PIECES = r"(\p{L}+|[^\p{L}]+)"
# what Python's str.strip() strips and its \s matches, as a class that Java and RE2 read alike
SPACE = r"[\s" + "".join(map(chr, [0x0B, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                                   0x202F, 0x205F, 0x3000])) + "]"
EDGE_SPACE = f"^{SPACE}+|{SPACE}+$"
NEWLINE_SPACE = rf"{SPACE}*\n{SPACE}*"
JSON_OBJECT_SHAPE = r"(?s)^\s*\{.*\}\s*$"

# HTML -> text: one pattern for all markup, taken in the order it stands in the
# page, as a parser does: script and style with their bodies (to the end of the
# page if they are never closed), comments, tags. A tag starts with a letter, a
# slash or a mark of declarations, and its quoted attributes may hold ">"; a tag
# whose quotes don't pair ends at its first ">". Then entities are decoded, each
# once, and white space is collapsed.
HTML_MARKUP = (
    r"(?is)<script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|<style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|<!--.*?-->"
    r"""|<[a-z/!?][^'">]*(?:(?:"[^"]*"|'[^']*')[^'">]*)*>"""
    r"|<[a-z/!?][^>]*>",
)
# an entity, at the start of what follows an ampersand
ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def entity_codes() -> dict[str, int]:
    """Code point of every named entity, from the standard library's table."""
    return dict(name2codepoint) | {"apos": 39}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: white space at both ends (not only spaces)."""
    return F.regexp_replace(col(c), EDGE_SPACE, "")


def title_case(c) -> Column:
    """Python ``str.title()``: upper-case the first letter of every letter
    run, lower-case the rest (``o'neil 3rd`` -> ``O'Neil 3Rd``; unlike
    ``initcap`` which splits on spaces only)."""
    pieces = F.regexp_extract_all(F.lower(col(c)), F.lit(TITLE_PIECES), 1)
    return F.array_join(
        F.transform(pieces, lambda t: F.concat(_title(F.upper(F.substring(t, 1, 1))), t.substr(F.lit(2), F.length(t)))),
        "")


def _title(upper: Column) -> Column:
    """An upper-cased letter in title case: some are several (``ß`` -> ``SS`` -> ``Ss``)."""
    return F.concat(F.substring(upper, 1, 1), F.lower(F.substring(upper, 2, 2)))


def let(value: Column, then) -> Column:
    """``then(value)``, with ``value`` evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def decode_entities(c) -> Column:
    """Named and numeric character references decoded, once each; unknown
    names and numbers that are no character stay as they are."""
    # one literal, folded to a map once: 250 pairs of literals take long to plan
    codes = F.from_json(F.lit(json.dumps(entity_codes())), "map<string,int>")

    def code_of(name: Column) -> Column:
        return (F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10).cast("int"))
                .when(name.startswith("#"), F.substring(name, 2, 7).cast("int"))
                .otherwise(F.try_element_at(codes, name)))

    def char_of(code: Column) -> Column:
        real = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def decode(part: Column) -> Column:
        return let(F.regexp_extract(part, ENTITY, 1), lambda name: F.when(name != "", let(code_of(name), lambda code: F.concat(
            char_of(code), part.substr(F.length(name) + 2, F.length(part))))))

    def whole(text: Column) -> Column:
        parts = F.split(text, "&", -1)
        decoded = F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.coalesce(decode(p), F.concat(F.lit("&"), p))))
        return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)

    return let(col(c), whole)


def html_to_text(c) -> Column:
    """Visible text of an HTML page, lower-cased, white space collapsed."""
    t = col(c)
    for pattern in HTML_MARKUP:
        t = F.regexp_replace(t, pattern, " ")
    return F.lower(F.trim(F.regexp_replace(decode_entities(t), f"{SPACE}+", " ")))


def paged_text(c, pages: int = FIRST_PAGES) -> Column:
    """The first pages of a text whose pages end with a form feed (what a PDF's
    text comes as), joined by a space, lower-cased."""
    return F.lower(F.array_join(F.slice(F.split(col(c), "\f", -1), 1, pages), " "))


def source_text(url, body) -> Column:
    """A fetched source's text: the first pages of a PDF, else the visible text of its HTML."""
    return F.when(is_pdf(url), paged_text(body)).otherwise(html_to_text(body))


def first_words_pattern(n: int) -> str:
    """Anchored pattern whose groups 1..n are the first n letter runs."""
    inner = ""
    for _ in range(n - 1):
        inner = r"(?:\P{L}+(\p{L}+)" + inner + ")?"
    return r"^\P{L}*(\p{L}+)" + inner


def first_words(c, n: int = 3) -> list[Column]:
    """The first n letter runs of a text (null when there are fewer). The
    anchored match stops after the n-th word instead of tokenising the
    whole text."""
    pat = first_words_pattern(n)
    return [F.nullif(F.regexp_extract(col(c), pat, i), F.lit("")) for i in range(1, n + 1)]


def letter_terms(c) -> Column:
    """Array of letter runs (the terms used for linking)."""
    return F.regexp_extract_all(col(c), F.lit(LETTER_RUN), 0)


def keyword_excerpt(text, phrase, max_words: int = MAX_WORDS,
                    stop_word: str | None = STOP_WORD) -> Column:
    """Text from the first occurrence of ``phrase`` on (phrase included),
    newlines and the white space around them folded into one space, cut to
    ``max_words`` words split on single spaces (so empty words count), or
    up to and including the first exact ``stop_word`` within that budget.
    Empty when the phrase is absent, null or empty."""
    if max_words <= 0:
        raise ValueError("max_words must be > 0")
    return _excerpt(col(text), col(phrase), max_words, stop_word)


def _excerpt(text: Column, phrase: Column, max_words: int, stop_word: str | None) -> Column:
    pos = F.position(phrase, text)
    hit = phrase.isNotNull() & (phrase != "") & text.isNotNull() & (pos > 0)
    tail = F.when(hit, text.substr(pos, F.length(text) + 1))
    words = F.split(F.regexp_replace(tail, NEWLINE_SPACE, " "), " ", -1)
    head = F.slice(words, 1, max_words)
    if stop_word:
        k = F.array_position(head, F.lit(stop_word))
        head = F.when(k > 0, F.slice(words, F.lit(1), k.cast("int"))).otherwise(head)
    return F.when(hit, F.array_join(head, " ")).otherwise(F.lit(""))


def cascade_excerpt(text, last, first, middle, max_words: int = MAX_WORDS,
                    stop_word: str | None = STOP_WORD) -> Column:
    """Excerpt anchored on the last name, else the first, else the middle
    name; empty when none of them occurs. ``coalesce`` is lazy, so later
    levels are only computed when earlier ones are empty."""
    text = col(text)
    levels = [F.nullif(_excerpt(text, col(p), max_words, stop_word), F.lit(""))
              for p in (last, first, middle)]
    return F.coalesce(*levels, F.lit(""))


def cascade_level(text, last, first, middle) -> Column:
    """Which name the cascade anchors on: 'last', 'first', 'middle' or 'none'."""
    text = col(text)

    def found(p):
        p = col(p)
        return p.isNotNull() & (p != "") & (F.position(p, text) > 0)

    return (F.when(found(last), "last").when(found(first), "first")
            .when(found(middle), "middle").otherwise("none"))


def parse_list_literal(c) -> Column:
    """``"['a', 'b']"`` -> ``[a, b]``: drop the brackets, split on commas,
    strip each item and delete apostrophes (``[]`` gives ``['']``)."""
    s = col(c)
    inner = s.substr(F.lit(2), F.length(s) - 2)
    return F.transform(F.split(inner, ",", -1),
                       lambda item: F.replace(strip(item), F.lit("'"), F.lit("")))


def is_pdf(url) -> Column:
    """Case-sensitive ``.pdf`` anywhere in the URL."""
    return F.contains(col(url), F.lit(".pdf"))


def recover_excerpt(prompt) -> Column:
    """Excerpt of a stored prompt: after the last ``text: `` and before the
    first ``If any desired`` that follows it."""
    after = F.substring_index(col(prompt), PROMPT_TEXT_MARKER, -1)
    return F.substring_index(after, PROMPT_TAIL_MARKER, 1)


def null_tokens(c, tokens=NULL_TOKENS) -> Column:
    """Null for the usual "no value" spellings (after stripping)."""
    c = col(c)
    return F.when(strip(c).isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def estimated_tokens(c) -> Column:
    """Rough model-token count: one token per four characters."""
    return F.ceil(F.length(col(c)) / F.lit(4)).cast("bigint")
