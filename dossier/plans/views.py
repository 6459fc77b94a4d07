"""Derived views that bind the operators to the driver's tables.

The reference's own inputs (a candidate CSV, the web, a model) are not
shipped, so every view below is a plain Spark projection or join of the
given tables; their size grows with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.functions import text as T
from dossier.functions.states import decode_state
from dossier.operators.corpus import Corpus
from dossier.operators.joins import checked_broadcast
from dossier.sources.tables import spread, table  # noqa: F401  (table is re-exported)

# Padded state codes handed out by nation key. Keys 0-19 are known codes
# (with stray spaces to exercise the strip); 20-24 are outside the
# dictionary (an upper-case code among them) to exercise pass-through.
SAB_BY_NATION = (" al ", "ak", " az", "ar ", "  ca", "co", " ct ", "de", "fl ", " ga",
                 "hi", " id ", "il", "in ", " ia", "ks", "ky ", " la", "me", " md ",
                 " AL ", "zz", " pr ", "dc", " xx ")


def sab_for(key_col) -> F.Column:
    codes = F.array(*[F.lit(c) for c in SAB_BY_NATION])
    return F.element_at(codes, (F.pmod(key_col, F.lit(len(SAB_BY_NATION))) + 1).cast("int"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw entity source table: first, middle, last, suffix, min_year, sab,
    candid, plus the explicit row number ``row``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    return (
        c.join(checked_broadcast(n, 10_000), c.c_nationkey == n.n_nationkey)
        .select(
            k.alias("row"),
            k.cast("string").alias("candid"),
            F.col("c_mktsegment").alias("first"),
            F.when(k % 3 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("m"), (k % 7).cast("string"))).alias("middle"),
            F.col("n_name").alias("last"),
            F.when(k % 11 == 0, F.lit("jr")).otherwise(F.lit(None).cast("string")).alias("suffix"),
            (F.lit(1967) + k % 51).cast("int").alias("min_year"),
            sab_for(F.col("n_nationkey")).alias("sab"),
        )
    )


def text_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities for linking: the first words of the benchmark text are the
    first, middle and last name; item_id modulo 4 picks plain names, a first
    name of two words, a hyphenated last name, or a capitalised first and an
    apostrophe in the middle name. State and year follow the item id."""
    b = table(spark, sf_dir, "benchmark")
    k = F.col("item_id")
    w = T.first_words(F.lower("text"), 4)
    v = k % 4
    first = F.when(v == 1, F.concat(w[0], F.lit(" "), w[1])).when(v == 3, F.upper(w[0])).otherwise(w[0])
    middle = F.when(v == 1, w[2]).when(v == 3, F.concat(w[1], F.lit("'"), w[2])).otherwise(w[1])
    last = F.when(v == 2, F.concat(w[2], F.lit("-"), w[3])).when(v == 0, w[2]).otherwise(w[3])
    return b.select(
        k.alias("row"),
        k.cast("string").alias("candid"),
        first.alias("first"), middle.alias("middle"), last.alias("last"),
        F.concat_ws(" ", first, middle, last).alias("full"),
        (F.lit(1967) + k % 51).cast("int").alias("min_year"),
        decode_state(sab_for(k)).alias("state"),
    )


def page_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    """Crawled pages; their text is the visible text of the HTML, of a PDF its first pages."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return Corpus(p, T.source_text("url", "html"))


LANG_ATTR = r'<html[^>]*\blang="([^"]*)"'
URL_HOST = r"^[a-z]+://([^/?#:]+)"


def doc_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    """Documents as a corpus (page_id = doc_id), text lower-cased."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return Corpus(d.select(
        F.col("doc_id").alias("page_id"),
        F.concat(F.lit("doc://"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("body")), F.lower("body"))


def filtered_pages(spark: SparkSession, sf_dir: str, lang: str = "en",
                   host_suffixes: tuple[str, ...] = (".com",)) -> Corpus:
    """Pages restricted to one language (the page's ``lang`` attribute) and
    to hosts with one of the given suffixes (the country restriction)."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    host = F.regexp_extract("url", URL_HOST, 1)
    keep = F.regexp_extract("html", LANG_ATTR, 1) == lang
    keep = keep & F.greatest(*[F.endswith(host, F.lit(s)) for s in host_suffixes]) \
        if len(host_suffixes) > 1 else keep & F.endswith(host, F.lit(host_suffixes[0]))
    return Corpus(p.filter(keep).select("page_id", "url", "html"), T.source_text("url", "html"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged text: a conversation is a document, its turn the page number."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("seg_no"), "text")


# Reply variants built from each document (doc_id modulo their number picks
# one): valid, missing key, extra key, newlines inside, N/A answers, nested
# list, truncated, plain text, numeric confidence, code-fenced, a second
# object, a tail ending in a brace, a stray brace, two objects with a comma,
# the whole text as one answer. Items are either literal text or the name of a
# column of ``reply_parts``.
_K = ('"College Major": "', '", "Undergraduate Institution": "', '", "Highest Degree and Institution": "',
      '", "Work History": "', '", "Confidence Level": "')
REPLY_VARIANTS = (
    ["{" + _K[0], "w1", _K[1], "w2", " university" + _K[2] + "ba, ", "w3", " college" + _K[3], "w1", " ", "w2",
     _K[4], "conf", '"}'],
    ["{" + _K[0], "w1", _K[1], "w2", " university" + _K[2] + "N/A" + _K[4], "conf", '"}'],
    ["{" + _K[0], "w1", _K[1], "w2", _K[2] + "N/A" + _K[3], "w3", _K[4], "conf", '", "Party": "', "w3", '"}'],
    ["{\n" + _K[0], "w1", '",\n"Undergraduate Institution": "', "w2", "\nuniversity" + _K[2] + "N/A" + _K[3],
     "w3", _K[4], "conf", '"\n}'],
    ["{" + _K[0] + "N/A" + _K[1] + "N/A" + _K[2] + "N/A" + _K[3] + "N/A" + _K[4] + '0"}'],
    ["{" + _K[0], "w1", _K[1], "w2", _K[2] + 'N/A", "Work History": ["', "w1", '", "', "w2",
     '"], "Confidence Level": "', "conf", '"}'],
    ["{" + _K[0], "w1", _K[1], "w2"],
    ["No information about ", "w1", " was found."],
    ["{" + _K[0], "w1", _K[1], "w2", _K[2] + "N/A" + _K[3], "w3", '", "Confidence Level": ', "conf", "}"],
    ["```json\n{" + _K[0], "w1", '"}\n```'],
    ["{" + _K[0], "w1", '"} {"b": "', "w2", '"}'],
    ["{" + _K[0], "w1", '"} ', "w2", "}"],
    ["{" + _K[0], "w1", '"}}'],
    ["{" + _K[0], "w1", '"},{' + '"b": "', "w2", '"}'],
    ["{" + _K[0], "w1", _K[3], "whole", _K[4], "conf", '"}'],
)
REPLY_COLUMNS = ("w1", "w2", "w3", "conf", "whole")


# characters that a JSON string must escape, the backslash first
ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def reply_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text"))
    words = T.first_words(F.lower("text"), 3)
    return d.select(
        "doc_id", "source", "lang", "n_chars",
        *[F.coalesce(w, F.lit("")).alias(f"w{i}") for i, w in enumerate(words, 1)],
        (F.col("n_chars") % 100).cast("string").alias("conf"),
        escaped("text").alias("whole"))


def escaped(c) -> F.Column:
    """A text as the inside of a JSON string."""
    out = F.coalesce(F.col(c), F.lit(""))
    for ch, name in ESCAPES:
        out = F.replace(out, F.lit(ch), F.lit(name))
    return out


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model reply per document (candid = doc_id) with the entity
    attributes the extraction carries along."""
    p = reply_parts(spark, sf_dir)
    v = F.col("doc_id") % len(REPLY_VARIANTS)
    expr = None
    for i, parts in enumerate(REPLY_VARIANTS):
        body = F.concat(*[F.col(x) if x in REPLY_COLUMNS else F.lit(x) for x in parts])
        expr = F.when(v == i, body) if expr is None else expr.when(v == i, body)
    k = F.col("doc_id")
    return p.select(
        k.cast("string").alias("candid"), k.alias("row"),
        F.concat_ws(" ", "w1", "w2").alias("name"),
        decode_state(sab_for(k)).alias("state"),
        (F.lit(1967) + k % 51).cast("int").alias("min_year"),
        F.concat(F.lit("doc://"), F.col("source"), F.lit("/"), k.cast("string")).alias("sources"),
        "lang", "source", "n_chars",
        expr.alias("response"))


def birth_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text birth-year replies, one per document (doc_id % 4 picks:
    a bare year, a graduation year, N/A, a sentence with a birth year)."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    v = k % 4
    reply = (F.when(v == 0, (F.lit(1940) + k % 60).cast("string"))
             .when(v == 1, F.concat(F.lit("Graduated in "), (F.lit(1960) + k % 50).cast("string")))
             .when(v == 2, F.lit("N/A"))
             .otherwise(F.concat(F.lit("He was born in "), (F.lit(1930) + k % 70).cast("string"),
                                 F.lit(" and graduated in "), (F.lit(1955) + k % 70).cast("string"))))
    return d.select(k.cast("string").alias("candid"), reply.alias("reply"))
