"""Entity -> document linking (re-aimed web search: S-11, J-5, W-1, A-4).

A name part (first, middle, last) is split into its letter runs, in lower
case, so ``Mary Ann``, ``O'Neil`` and ``Smith-Jones`` are parts of two terms
each; a document contains a part when it contains all of its terms. Its score
for an entity is the number of contained parts (overlap), or the sum of the
BM25 weights of their distinct terms; the top ``r`` documents per entity are
kept, score descending, ties by document id. Entities that share a key are
one entity: repeated rows neither add to a score nor repeat a link.

With ``state`` the search text has a fourth part, the state's name, whose terms
weigh ``STATE_WEIGHT`` of a name's (a term that is both counts as a name's).

Exact top r without emitting (entity, document) pairs per shared term.
Let S(e, d) be the set of e's parts that d contains. If d is among e's top
r, then d is also among the top r of *all* documents containing S(e, d),
ranked by their partial score over S(e, d): every document that beats d
there contains S(e, d) too, scores at least as much for e (more parts add
weights, and can only raise a term's factor), and so also beats d for e. Hence:

1. each entity yields its non-empty subsets of parts (at most 7, with a state
   15); distinct weighted sets of their terms are what is searched, however
   many entities share one;
2. each is answered exactly by ``postings.search``: block maxima bound the
   scores of ranges of documents, the rarest term leads, and no posting is
   joined with another;
3. each entity takes the union of its subsets' top r (at most 15 r rows) and
   keeps the best r. A candidate found through a smaller subset can only be
   under-scored, never over-scored, so the result equals the exhaustive one.

The corpus is read once: its vocabulary-only postings (document id, term,
weight; no url) are written once as a block index in the shared checkpoint
folder. Urls are attached to the final top r rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.functions import text as T
from dossier.operators import postings as PO
from dossier.operators.corpus import as_corpus
from dossier.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_count, hint_if
from dossier.session import materialize

MAX_R = 4
# name parts per entity (first, middle, last): at most 7 subsets each, 15 with a state
MAX_SUBSET = 3
# what a term of the state weighs beside one of the name
STATE_WEIGHT = 0.5


def check_r(r: int) -> None:
    if not 1 <= r <= MAX_R:
        raise ValueError(f"r must be in 1..{MAX_R}, got {r}")


def entity_parts(entities: DataFrame, key: str = "candid", name_cols=("first", "middle", "last"),
                 state: str | None = None) -> DataFrame:
    """(key, part, weak): the distinct non-empty name parts of each entity, each
    as the sorted array of its terms (at most MAX_SUBSET parts, which bounds the
    subsets per entity), and the state's, which is weak unless a name has it too."""
    if not 1 <= len(name_cols) <= MAX_SUBSET:
        raise ValueError(f"1..{MAX_SUBSET} name columns, got {len(name_cols)}")

    def terms(c):
        return F.array_sort(F.array_distinct(T.letter_terms(F.lower(F.coalesce(F.col(c), F.lit(""))))))
    parts = F.array(*[F.struct(terms(c).alias("part"), F.lit(c == state).alias("weak"))
                      for c in (*name_cols, *([state] if state else []))])
    rows = entities.dropDuplicates([key]).select(key, F.inline(F.filter(parts, lambda x: F.size(x["part"]) > 0)))
    return rows.groupBy(key, "part").agg(F.min("weak").alias("weak"))


def top_r(scored: DataFrame, key: str, r: int, score: str = "score",
          tiebreak: str = "page_id") -> DataFrame:
    """Keep the r best rows per key, rank 1..r (score desc, tiebreak asc)."""
    check_r(r)
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(tiebreak).asc())
    return (scored.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= r))


def _terms(parts: DataFrame) -> DataFrame:
    return parts.select(F.explode("part").alias("term")).distinct()


def _blocks(corpus, vocab: DataFrame, lengths: bool) -> DataFrame:
    """Staged blocks of the vocabulary's postings, in one pass over the corpus.
    With ``lengths`` words are counted as often as they stand, and every document
    gives one row of the null term, which carries its length; without, a word
    stands once per document."""
    terms = T.letter_terms("text")
    docs = as_corpus(corpus).texts()
    if lengths:
        docs = docs.select("page_id", terms.alias("terms"))
        rows = (docs.select("page_id", F.size("terms").alias("dl"), F.explode(F.concat(
            F.array(F.lit(None).cast("string")), "terms")).alias("term"))
            .join(vocab.withColumn("_in_vocab", F.lit(True)), "term", "left")
            .filter(F.col("term").isNull() | F.col("_in_vocab")).select("term", "page_id", "dl"))
    else:
        rows = docs.select("page_id", F.lit(0).alias("dl"), F.explode(F.array_distinct(terms)).alias("term")).join(vocab, "term")
    return materialize(PO.block_rows(rows), "blocks")


def link_overlap(entities: DataFrame, corpus, r: int = MAX_R,
                 key: str = "candid", prune_from: int = PO.PRUNE_FROM) -> DataFrame:
    """Top r documents per entity by the number of distinct name parts the
    document contains. corpus: a Corpus or (page_id, url, text). Returns
    (key, page_id, url, score, rank); entities without any match are absent."""
    check_r(r)
    parts = entity_parts(entities, key)
    n_parts = bounded_count(parts)
    blocks = _blocks(corpus, hint_if(_terms(parts), n_parts <= DEFAULT_BROADCAST_ROWS), lengths=False)
    index = PO.block_index(blocks, lambda d: F.lit(1), r)
    freq = blocks.groupBy("term").agg(F.sum("n").alias("_df"))
    found = subset_candidates(parts, freq, index, key, r, n_parts, by_parts=True, prune_from=prune_from)
    return with_urls(top_r(found, key, r), corpus, r, n_parts)


def link_bm25(entities: DataFrame, corpus, r: int = MAX_R, key: str = "candid", k1: float = 1.2, b: float = 0.75,
              state: str | None = None, prune_from: int = PO.PRUNE_FROM) -> DataFrame:
    """Top r documents per entity by Okapi BM25 of the name terms, and with
    ``state`` (a column) of the state's at STATE_WEIGHT, with the
    always-positive idf ln(1 + (N - df + 0.5) / (df + 0.5)); no term and no
    candidate is dropped. Returns (key, page_id, url, score, rank). The corpus
    size N, the average length and the weights read the staged blocks, not the
    corpus."""
    check_r(r)
    parts = entity_parts(entities, key, state=state)
    n_parts = bounded_count(parts)
    small = n_parts <= DEFAULT_BROADCAST_ROWS
    every = _blocks(corpus, hint_if(_terms(parts), small), lengths=True)
    got = every.filter(F.col("term").isNull()).agg(F.sum("n").alias("n"), F.sum("dl").alias("total")).first()
    n_docs = int(got["n"] or 0)
    avgdl = float(got["total"] or 0) / n_docs if n_docs else 1.0
    blocks = every.filter(F.col("term").isNotNull())
    freq = blocks.groupBy("term").agg(F.sum("n").alias("_df"))
    idf = F.log(F.lit(1.0) + (F.lit(n_docs) - F.col("_df") + 0.5) / (F.col("_df") + 0.5))

    def weight(d):
        norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * d["dl"] / F.lit(avgdl or 1.0))
        return idf * d["tf"] * F.lit(k1 + 1.0) / (d["tf"] + norm)
    index = PO.block_index(blocks.join(hint_if(freq, small), "term"), weight, r)
    found = subset_candidates(parts, freq, index, key, r, n_parts, prune_from=prune_from)
    return with_urls(top_r(found, key, r), corpus, r, n_parts)


def subset_searches(parts: DataFrame, freq: DataFrame, key: str, small: bool) -> DataFrame:
    """(key, sid, terms, n_parts) per entity and subset of its parts; terms are
    (term, f), the rarest first (document frequency, then the term itself: one
    global order, so equal sets give equal arrays)."""
    # parts all of whose terms occur, each term with its document frequency
    known = (parts.withColumn("term", F.explode("part")).join(hint_if(freq, small), "term")
             .groupBy(key, "part").agg(F.collect_list(F.struct("_df", "term", "weak")).alias("_t"))
             .where(F.size("_t") == F.size("part")))
    grouped = known.groupBy(key).agg(F.collect_list("_t").alias("_ps"))
    chosen = (grouped.select(key, "_ps", F.explode(F.expr("sequence(1, shiftleft(1, size(_ps)) - 1)")).alias("_m"))
              .select(key, F.expr("filter(_ps, (x, i) -> (shiftright(_m, i) & 1) = 1)").alias("_c"))
              .select(key, F.array_sort(F.array_distinct(F.flatten("_c"))).alias("_s"), F.size("_c").alias("n_parts")))
    # a term that a name and the state share stands twice, the name's (not weak) first
    once = F.filter("_s", lambda x, i: (i == 0) | (x["term"] != F.get("_s", i - 1)["term"]))
    terms = F.transform(once, lambda x: F.struct(x["term"].alias("term"), F.when(x["weak"], STATE_WEIGHT).otherwise(1.0).alias("f")))
    named = chosen.select(key, terms.alias("terms"), "n_parts")
    sid = F.array_join(F.transform("terms", lambda x: F.concat(x["term"], F.when(x["f"] < 1, "*").otherwise(""))), " ")
    return named.select(key, sid.alias("sid"), "terms", "n_parts")


def subset_candidates(parts: DataFrame, freq: DataFrame, index: DataFrame, key: str, r: int, n_parts: int,
                      by_parts: bool = False, prune_from: int = PO.PRUNE_FROM) -> DataFrame:
    """(key, page_id, score): for every entity, the union of the top r
    documents of each of its subsets of parts (see the module notes), scored
    by the best partial score found, or with ``by_parts`` by the number of parts.
    ``n_parts`` is the (bounded) row count of ``parts``: the subset table has
    at most 15/4 of it (4 parts -> 15 subsets), which decides the broadcasts
    without another count."""
    most = -(-15 * n_parts // 4)
    small = n_parts <= DEFAULT_BROADCAST_ROWS
    subsets = materialize(subset_searches(parts, freq, key, small), "subsets")
    searches = subsets.select("sid", "terms").dropDuplicates(["sid"])
    best = PO.search(searches, index, r, most, prune_from)
    # at most r rows per subset; broadcast under the same proven bound, the
    # entity side keeps its hash partitioning by key, so the max per
    # (entity, document) and the caller's top-r window need no exchange
    best = hint_if(best, r * most <= DEFAULT_BROADCAST_ROWS)
    score = F.col("n_parts").cast("long") if by_parts else F.col("score")
    return (subsets.select(key, "sid", "n_parts").join(best, "sid")
            .groupBy(key, "page_id").agg(F.max(score).alias("score")))


def with_urls(links: DataFrame, corpus, r: int, n_parts: int) -> DataFrame:
    """Adds each linked document's url. Postings and candidates carry only
    the document id; the (at most r per entity, so at most r x n_parts)
    link rows are broadcast under that bound and a (page_id, url)
    projection of the corpus streams past them, so the link plan runs once
    and the corpus is not shuffled."""
    out = links.columns
    pages = as_corpus(corpus).df.select("page_id", "url")
    joined = pages.join(hint_if(links, r * n_parts <= DEFAULT_BROADCAST_ROWS), "page_id")
    return joined.select(*out[:2], "url", *out[2:])
