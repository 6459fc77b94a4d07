"""Benchmark decontamination by spaced seeds (operator 6). DataFrame
functions only.

A document overlaps a benchmark item if some ``WINDOW`` words of each, word by
word in place, differ in at most ``SUBSTITUTIONS``. Words are runs of letters
and digits, in lower case, so that marks and case don't matter.

A spaced seed hashes the words at the positions of a fixed mask and ignores
those between. The two masks below are lossless: whatever two words of a
window of 13 are replaced, one of them fits somewhere beside both (a test goes
through all cases). Document hashes are joined with benchmark hashes; around
every hit the words are compared in place, and the best window that holds the
seed decides.

Hits only name a row, an item and a shift, and are made distinct in the task
that finds them, before anything is buffered or shuffled; a text in which one
item comes back a thousand times thus costs its shifts, not its words times
its hits. Only then the words of rows with a hit are brought back, once per
row and item, and each diagonal is compared in place. A row is known by two
64-bit hashes of its key and text, so nothing is numbered or staged but the
hits; equal rows are one.

The benchmark's seeds are broadcast only if they are few (``BROADCAST_SEEDS``):
then hashes and join run in the scan and no document word is shuffled but
those of rows with a hit. Beyond that, (hash, row, position) is joined by a
shuffle; both ways give the same rows.

An item of ``SHORTEST`` to 10 words is below the window: it overlaps where all
its words stand in place. Shorter ones are left to chance and overlap nothing.

Inputs and their results: a null or empty text, or one without letters and
digits, overlaps nothing, nor does an item of fewer than ``SHORTEST`` words;
whole texts count; repeated rows give the same pair once;
a null document or item id is a value like any other; empty tables on either
side give no pairs; other columns are not read, and ``decontaminated`` returns
them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.base import count_over, numbered, stage, table

WINDOW, SUBSTITUTIONS = 13, 2
#: The masks, as positions from the seed's first word.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
BROADCAST_SEEDS = 1_000_000
#: Rows with a hit whose hashes may be broadcast, 16 bytes each.
BROADCAST_ROWS = 500_000
#: An item of fewer words overlaps nothing; below ENOUGH words it must stand whole.
SHORTEST, ENOUGH = 5, WINDOW - SUBSTITUTIONS


def words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def seeds(rows: DataFrame, at: str, lengths: list[int], whole_item: bool = False) -> DataFrame:
    """``rows`` (with an array ``words``) once per position ``at`` and mask that
    fits there: the number of the mask and the hash of its words. After the
    masks come runs of ``lengths`` words, for the items that must stand whole."""
    size = F.size("words")
    placed = rows.where(size > 0).select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias(at))

    def hashed(kind: int, offsets: tuple[int, ...], fits: Column) -> Column:
        return F.when(fits, F.xxhash64(F.lit(kind), *[F.get("words", F.col(at) + o) for o in offsets]))
    hashes = [hashed(m, mask, (F.col(at) + mask[-1] < size) & ((size >= ENOUGH) | F.lit(not whole_item)))
              for m, mask in enumerate(MASKS)]
    hashes += [hashed(-n, tuple(range(n)), (size == n) if whole_item else (F.col(at) + n <= size)) for n in lengths]
    return placed.select("*", F.posexplode(F.array(*hashes)).alias("mask", "seed")).where("seed is not null")


def best_window(text: Column, item: Column, shift: Column) -> Column:
    """The most equal words, in place, of any frame of WINDOW places when item
    word t stands at text word t + shift: one pass with the last WINDOW
    comparisons as bits. A short item counts its equal words."""
    def step(acc: Column, t: Column) -> Column:
        bits = F.shiftleft(acc.bits, 1).bitwiseAND(F.lit((1 << WINDOW) - 1)).bitwiseOR(
            F.when(F.get(item, t) == F.get(text, t + shift), 1).otherwise(0))
        return F.struct(bits.alias("bits"), F.greatest(acc.best, F.bit_count(bits)).alias("best"))

    first = F.greatest(F.lit(0), -shift)
    last = F.least(F.size(item), F.size(text) - shift) - 1
    places = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.struct(F.lit(0).alias("bits"), F.lit(0).alias("best")), step, lambda acc: acc.best)


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text", broadcast_seeds: int = BROADCAST_SEEDS,
             broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(key, item, equal_words) per document key and item that overlap; equal_words
    is that of the best window. Rows of equal key count together."""
    spark = docs.sparkSession
    items, no = numbered(benchmark.select(F.col(item_col).alias("item"), words(item_text).alias("item_words")),
                         "benchmark")
    n = F.size("item_words")
    total, lengths = items.agg(F.sum(n.cast("long") * len(MASKS)), F.array_sort(F.collect_set(
        F.when((n >= SHORTEST) & (n < ENOUGH), n)))).first()
    wanted = seeds(items.select(F.col(no).alias("item_no"), F.col("item_words").alias("words")), "item_at", lengths, True)
    wanted = wanted.select("item_no", "item_at", "mask", "seed")

    rows = docs.select(F.col(key).alias("key"), F.col(text_col).alias("text")).select(
        "key", "text", F.xxhash64("key", "text").alias("row_a"), F.xxhash64(F.lit(7), "key", "text").alias("row_b"))
    placed = seeds(rows.select("row_a", "row_b", words("text").alias("words")), "at", lengths)
    placed = placed.select("row_a", "row_b", "at", "mask", "seed")
    hits = placed.join(F.broadcast(wanted) if (total or 0) <= broadcast_seeds else wanted, ["mask", "seed"])
    hits = hits.select("row_a", "row_b", "item_no", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    pairs = stage(hits.groupBy("row_a", "row_b", "item_no").agg(F.collect_list("shift").alias("shifts")), "seed-hits")

    hit_rows = pairs.select("row_a", "row_b").distinct()
    if not count_over(spark, hit_rows, broadcast_rows):
        rows = rows.join(F.broadcast(hit_rows), ["row_a", "row_b"], "left_semi")
    # merged with the hits on the left: a text is read once and never stands in memory once per item
    found = pairs.join(rows.hint("merge"), ["row_a", "row_b"]).join(
        items.select(F.col(no).alias("item_no"), "item", "item_words"), "item_no")
    # transform over one value names it, so that no later rewriting computes it once per use
    equal = F.transform(F.array(words("text")), lambda text: F.array_max(F.transform(
        "shifts", lambda s: best_window(text, F.col("item_words"), s))))
    enough = F.get(F.filter(equal, lambda e: e >= F.least(F.lit(ENOUGH), n)), F.lit(0))
    checked = found.groupBy("key", "item").agg(F.max(enough).alias("equal_words")).where("equal_words is not null")
    return checked.select(F.col("key").alias(key), F.col("item").alias(item_col), "equal_words")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text: str = "text", **limits: int) -> DataFrame:
    """The rows of ``docs`` that overlap no item. ``limits`` as in ``overlaps``."""
    rows, rid = numbered(docs, "decontaminate-docs")
    found = overlaps(rows.select(rid, text_col), benchmark, rid, text_col, item_col, item_text, **limits)
    return rows.join(found.select(rid).distinct(), rid, "left_anti").select(*docs.columns)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Every pair of equal words on a diagonal, counted in frames of 13 places.
OP6_SQL = rf"""
WITH dw AS (SELECT doc_id, generate_subscripts(l, 1) AS p, unnest(l) AS w FROM (
       SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS l
       FROM documents)),
bw AS (SELECT item_id, len(l) AS n, generate_subscripts(l, 1) AS q, unnest(l) AS w FROM (
       SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS l
       FROM benchmark) WHERE len(l) >= {SHORTEST}),
same AS (SELECT doc_id, item_id, n AS item_words, p - q AS shift, q FROM dw JOIN bw USING (w)),
counted AS (SELECT doc_id, item_id, item_words, count(*) OVER (
       PARTITION BY doc_id, item_id, shift ORDER BY q RANGE BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS n FROM same)
SELECT doc_id, item_id, max(n)::INT AS equal_words FROM counted WHERE n >= least({ENOUGH}, item_words)
GROUP BY doc_id, item_id"""

QUERIES = {"op6_decontamination": op6_decontamination}
ORACLE = {"op6_decontamination": OP6_SQL}
