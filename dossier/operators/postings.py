"""A stored index of postings with block maxima, and exact top-r search in it.

``block_index`` keeps, per term and range of 2 ** ``RANGE_BITS`` document ids,
one row: the documents with their weights, the greatest weight (``top``) and the
``best`` few documents. Rows lie sorted by term and range in their files, so a
search reads the row groups of its terms.

A search (``sid``) is a set of weighted terms; documents that hold all of them
are ranked by the sum of factor times weight, ties by id. It is answered on
blocks, never by joining postings with postings:

1. the ranges that hold the rarest term are met with the ranges of the other
   terms, one row a block; the sum of ``top`` bounds every score in the range;
2. the r best bounded ranges of each search are scored first and give its r-th
   best score so far;
3. of the other ranges only those are scored whose bound still reaches it (for
   an equal bound: whose ids are smaller, since ties go to the smaller id).

A search for one term takes the best documents of its blocks. For several, the
blocks are dealt by range, where all that is known of a document meets, and a
range gives its r best at most; no hit is shuffled.

A term in a third of all documents thus costs one row per 1,024 of them in step
1, and only ranges that can still win are opened. Where few ranges are met at
all (``PRUNE_FROM``), steps 2 and 3 are one; the rows are the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators.joins import DEFAULT_BROADCAST_ROWS, hint_if
from dossier.session import materialize

RANGE_BITS = 10
#: (search, range) rows from which ranges are opened in two steps.
PRUNE_FROM = 500_000
#: Scores are ranked to this many digits, so that the order of sums cannot reorder ties.
DIGITS = 9
_HALF = 0.25 * 10.0 ** -DIGITS


def range_of(page_id: str | Column) -> Column:
    return F.shiftright(F.col(page_id) if isinstance(page_id, str) else page_id, RANGE_BITS)


def block_rows(occurrences: DataFrame) -> DataFrame:
    """Occurrences (term, page_id, dl), one per word, as blocks (term, range, n,
    docs): one exchange by block; a document's count and its block are formed
    behind it. The null term stands once per document and carries its length."""
    dealt = occurrences.withColumn("range", range_of("page_id")).repartition("term", "range")
    counted = dealt.groupBy("term", "range", "page_id", "dl").agg(F.count(F.lit(1)).alias("tf"))
    return counted.groupBy("term", "range").agg(
        F.collect_list(F.struct("page_id", "tf", "dl")).alias("docs"), F.count(F.lit(1)).alias("n"), F.sum("dl").alias("dl"))


def block_index(blocks: DataFrame, weight, r: int) -> DataFrame:
    """The stored index (term, range, top, best, docs) of blocks, where docs holds
    (page_id, w) and ``weight`` gives w of a document; best holds the r best."""
    docs = F.transform("docs", lambda d: F.struct(d["page_id"].alias("page_id"), weight(d).cast("double").alias("w")))
    index = blocks.select("term", "range", docs.alias("docs"))
    ranked = F.array_sort(F.transform("docs", lambda d: F.struct((-F.round(d["w"], DIGITS)).alias("less"), d["page_id"].alias("page_id"))))
    index = index.select("term", "range", F.array_max(F.transform("docs", lambda d: d["w"])).alias("top"),
                         F.transform(F.slice(ranked, 1, r), lambda d: F.struct(
                             d["page_id"].alias("page_id"), (-d["less"]).alias("score"))).alias("best"), "docs")
    return materialize(index.sortWithinPartitions("term", "range"), "block-index")


def bounds(searches: DataFrame, index: DataFrame, small: bool) -> DataFrame:
    """(sid, range, bound) for every range that holds all terms of a search.
    ``searches`` is (sid, terms), terms an array of (term, f), the rarest first."""
    tops = index.select("term", "range", "top")
    first = searches.select("sid", F.col("terms")[0]["term"].alias("term"), F.col("terms")[0]["f"].alias("f"),
                            F.slice("terms", 2, F.size("terms")).alias("rest"))
    met = tops.join(hint_if(first, small), "term").select("sid", "range", (F.col("top") * F.col("f")).alias("bound"), "rest")
    alone = met.where(F.size("rest") == 0).select("sid", "range", "bound")
    more = met.where(F.size("rest") > 0).select("sid", "range", "bound", F.size("rest").alias("need"), F.inline("rest"))
    more = more.join(tops, ["term", "range"]).groupBy("sid", "range").agg(
        F.first("bound").alias("first"), F.first("need").alias("need"), F.count(F.lit(1)).alias("got"),
        F.sum(F.col("top") * F.col("f")).alias("others")).where("got = need")
    return alone.unionByName(more.select("sid", "range", (F.col("first") + F.col("others")).alias("bound")))


def scored(chosen: DataFrame, searches: DataFrame, index: DataFrame, r: int, small: bool) -> DataFrame:
    """(sid, page_id, score): the r best documents of each search within the
    chosen ranges (sid, range)."""
    asked = chosen.select("sid", "range").join(hint_if(searches, small), "sid").select(
        "sid", "range", F.size("terms").alias("need"), F.inline("terms"))
    whole = (F.col("need") == 1) & (F.col("f") == 1)
    alone = index.select("term", "range", "best").join(asked.where(whole), ["term", "range"]).select("sid", F.inline("best"))
    hits = index.select("term", "range", "docs").repartition("range").join(
        hint_if(asked.where(~whole), small), ["term", "range"]).select("sid", "range", "need", "f", F.inline("docs"))
    found = hits.groupBy("range", "sid", "page_id", "need").agg(
        F.count(F.lit(1)).alias("got"), F.round(F.sum(F.col("w") * F.col("f")), DIGITS).alias("score")).where("got = need")
    w = Window.partitionBy("range", "sid").orderBy(F.col("score").desc(), F.col("page_id").asc())
    found = found.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= r).select("sid", "page_id", "score")
    return best(alone.unionByName(found), r)


def best(found: DataFrame, r: int) -> DataFrame:
    """The r best rows of each search; Spark limits every map task's group first."""
    w = Window.partitionBy("sid").orderBy(F.col("score").desc(), F.col("page_id").asc())
    return found.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= r).drop("_n")


def search(searches: DataFrame, index: DataFrame, r: int, n_searches: int,
           prune_from: int = PRUNE_FROM) -> DataFrame:
    """(sid, page_id, score): the r best documents of each search that hold all
    its terms. ``n_searches`` is a bound on the rows of ``searches``. Inside,
    searches go by number: hits are many, and numbers are cheap to group by."""
    small = n_searches <= DEFAULT_BROADCAST_ROWS
    named = materialize(searches.withColumn("no", F.monotonically_increasing_id()), "searches")
    found = answered(named.select(F.col("no").alias("sid"), "terms"), index, r, small, prune_from)
    return found.withColumnRenamed("sid", "no").join(hint_if(named.select("no", "sid"), small), "no").select(
        "sid", "page_id", "score")


def answered(searches: DataFrame, index: DataFrame, r: int, small: bool, prune_from: int) -> DataFrame:
    """``search`` for searches that go by number."""
    met = materialize(bounds(searches, index, small), "search-ranges")
    if met.limit(prune_from + 1).count() <= prune_from:
        return scored(met, searches, index, r, small and 6 * prune_from <= 2 * DEFAULT_BROADCAST_ROWS)
    order = Window.partitionBy("sid").orderBy(F.col("bound").desc(), F.col("range").asc())
    first = met.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= r).drop("_n")
    first = materialize(first, "first-ranges")
    opened = materialize(scored(first, searches, index, r, small), "first-scores")
    # the r-th best so far, if there are r
    last = opened.groupBy("sid").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("score", (-F.col("page_id")).alias("i"))).alias("l"))
    last = last.where(F.col("n") == r).select("sid", F.col("l.score").alias("least"), range_of(-F.col("l.i")).alias("at"))
    rest = met.join(first.select("sid", "range"), ["sid", "range"], "left_anti").join(last, "sid", "left")
    rest = rest.where(F.col("least").isNull() | (F.col("bound") > F.col("least") + _HALF)
                      | ((F.col("bound") > F.col("least") - 4 * _HALF) & (F.col("range") < F.col("at"))))
    return best(opened.unionByName(scored(rest, searches, index, r, small)), r)
