"""Line dedup by a suffix array over line ids (operator 1). DataFrame
functions only.

The corpus is one sequence of lines, document after document in the order of
their ids, with a break between documents. A *run* is a stretch of lines
within a document; it is a later copy if the same lines stand somewhere before
it (in an earlier document or further up; copies may overlap). Maximal later
copies of at least ``min_words`` words are deleted. The first copy of a line
always stays, so no line's content is lost.

**Prefix doubling.** Round k finds, for the suffix at each position, the class
of its first 2^(k+1) lines from the pair (class of this position, class of the
position 2^k further on), starting from the classes of equal lines (by 128-bit
hash). A class is named by its first position. A suffix whose prefix is unique
has its final place and leaves the rounds, so they shrink fast; their number
is the logarithm of the longest repeated run. The suffix array has the
suffixes in the order in which, wherever prefixes part, the one that occurs
first comes first; every class is an interval of it with a common prefix of at
least 2^k lines (``suffix_array`` lists it; the deletions need only its
intervals).

**Longest common prefixes.** For each suffix, the longest prefix that also
starts at an earlier position is found from the top round down, one binary
digit a round: within an interval of common prefix l, suffixes that agree on
the next 2^b lines form an interval of prefix l + 2^b. All but its first
suffix move into it; the first stays where it is, and stands in the inner
interval too, as the copy that the others repeat.

**Scale.** Only numbers move in the rounds: positions, classes and lengths.
A line or run that fills a third of the corpus is counted by partial
aggregates and joined against one row per key, which Spark's skew join splits.
Every round is staged in the shared folder. Text moves once, at the end, to
have its intervals cut out.

Inputs and their results: lines are compared without outer white space; blank
lines are lines of no words; a null text has no lines and stays null; an empty
text stays empty; documents with equal ids follow in row order, those with a
null id come last; a repeated row is a later copy of the first; a text all of
whose lines go becomes empty; an empty table gives an empty one; other columns
are returned as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.base import SPACES, WORD, fresh, numbered, stage, table

#: Words of the shortest run that is deleted.
MIN_WORDS = 50


def _breaks(text: str | Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def starts(docs: DataFrame) -> DataFrame:
    """(rid, start): the position of each document's first line, by (id,
    row). ``docs`` has rid, id and n lines. A position stays free after each
    document, as the break."""
    sized = docs.select("rid", F.isnull("id").alias("none"), "id", (F.col("n") + 1).cast("long").alias("n"))
    ranged = sized.repartitionByRange("none", "id", "rid").sortWithinPartitions("none", "id", "rid")
    cut = stage(ranged.select("rid", "n", F.spark_partition_id().alias("part"),
                              F.monotonically_increasing_id().alias("at")), "line-starts")
    # one row per range partition
    parts = cut.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n").over(Window.partitionBy("part").orderBy("at")) - F.col("n")
    return cut.withColumn("within", within).join(F.broadcast(before), "part").select(
        "rid", (F.col("before") + F.col("within")).alias("start"))


def redealt(grouped: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows under keys that Spark doesn't know to be dealt out
    already. Joined back, they get an exchange of their own, right below the
    join, and so Spark's skew join can split a key of many rows."""
    return grouped.withColumns({k: F.col(k).bitwiseXOR(F.lit(0).cast("long")) for k in keys})


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(pos, rid, start, first, words, cum) of every line that occurs twice:
    cum is the number of words in such lines of the document before."""
    split = docs.where("text is not null").select("rid", F.posexplode(F.split("text", "\n", -1)).alias("line", "s"))
    trimmed = F.trim(F.col("s"), F.lit(SPACES))
    lines = stage(split.select("rid", "line", F.xxhash64(trimmed).alias("h1"), F.xxhash64(F.lit(1), trimmed).alias("h2"),
                               F.regexp_count("s", F.lit(WORD)).alias("words")), "lines")
    twice = lines.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2")
    found = lines.join(redealt(twice, ["h1", "h2"]), ["h1", "h2"]).join(starts(docs), "rid")
    found = found.withColumn("pos", F.col("start") + F.col("line"))
    cum = F.sum("words").over(Window.partitionBy("rid").orderBy("pos")) - F.col("words")
    found = stage(found.select("pos", "rid", "start", "h1", "h2", "words", cum.alias("cum")), "repeated-lines")
    first = found.groupBy("h1", "h2").agg(F.min("pos").alias("first"))
    return stage(found.join(redealt(first, ["h1", "h2"]), ["h1", "h2"]).drop("h1", "h2"), "repeated-lines")


def doubled(level: DataFrame, step: int) -> DataFrame:
    """From the suffixes (pos, first) that share their first ``step`` lines
    with others to those that share twice as many."""
    sides = level.select("first", F.explode(F.array(
        F.struct("pos", F.lit(True).alias("own")),
        F.struct((F.col("pos") - step).alias("pos"), F.lit(False).alias("own")))).alias("s"))
    pairs = sides.groupBy("s.pos").agg(F.max(F.when(F.col("s.own"), F.col("first"))).alias("c1"),
                                       F.max(F.when(~F.col("s.own"), F.col("first"))).alias("c2"))
    pairs = pairs.where("c1 is not null and c2 is not null")
    shared = pairs.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.min("pos").alias("first")).where("n > 1")
    return stage(pairs.join(redealt(shared.drop("n"), ["c1", "c2"]), ["c1", "c2"]).select("pos", "first"), "line-level")


def suffix_levels(lines: DataFrame) -> list[DataFrame]:
    """Levels 0, 1, 2 ...: (pos, first) of the suffixes whose first 2^k lines occur twice."""
    levels = [lines.select("pos", "first")]
    while True:
        following = doubled(levels[-1], 1 << (len(levels) - 1))
        if following.isEmpty():
            return levels
        levels.append(following)


def suffix_array(levels: list[DataFrame]) -> DataFrame:
    """The suffixes that share a line with another, in the order of the suffix
    array: (pos, path), path the classes of their prefixes, shortest first."""
    rows = None
    for b, level in enumerate(levels):
        named = level.select("pos", F.struct(F.lit(b).alias("level"), "first").alias("class"))
        rows = named if rows is None else rows.unionByName(named)
    path = F.transform(F.sort_array(F.collect_list("class")), lambda c: c["first"])
    return rows.groupBy("pos").agg(path.alias("path")).orderBy("path", "pos")


def longest_copies(levels: list[DataFrame], singles: DataFrame) -> DataFrame:
    """(pos, len): the longest run from each position that also starts
    earlier. ``singles`` are the suffixes of level 0 worth having at length 1."""
    # each suffix enters at the longest level where it is a later copy, and
    # beyond it as the first of its class; a position has a row a level
    rows = singles.select(F.lit(0).alias("level"), "pos", "first")
    for b, level in enumerate(levels[1:], 1):
        rows = rows.unionByName(level.select(F.lit(b).alias("level"), "pos", "first"))
    last = F.max(F.when(F.col("first") != F.col("pos"), F.col("level"))).over(Window.partitionBy("pos"))
    entries = stage(rows.withColumn("last", last).where("last is null or level >= last").drop("last"), "line-entries")
    held = None
    for b in range(len(levels) - 1, -1, -1):
        entered = entries.where(F.col("level") == b).select("pos", F.lit(1 << b).cast("long").alias("len"), "first")
        held = stage(entered if held is None else refined(held, levels[b], 1 << b).unionByName(entered), "line-copies")
    return held.where("pos != first").select("pos", "len")


def refined(held: DataFrame, level: DataFrame, step: int) -> DataFrame:
    """Split the intervals (len, first) of ``held`` by the next ``step`` lines."""
    ahead = held.withColumn("at", F.col("pos") + F.col("len")).join(
        level.select(F.col("pos").alias("at"), F.col("first").alias("next")), "at", "left").drop("at")
    key = ["len", "first", "next"]
    inner = ahead.where("next is not null").groupBy(*key).agg(F.count("*").alias("n"), F.min("pos").alias("lead"))
    known = ahead.join(redealt(inner.where("n > 1").drop("n"), key), key, "left")
    # a follower moves; the first stays, and leads the inner interval too
    stay, move = F.struct("len", "first"), F.struct((F.col("len") + step).alias("len"), F.col("lead").alias("first"))
    places = F.when(F.col("lead").isNull(), F.array(stay)).when(F.col("pos") == F.col("lead"), F.array(stay, move)).otherwise(
        F.array(move))
    return known.select("pos", F.explode(places).alias("p")).select("pos", "p.len", "p.first")


def later_copies(docs: DataFrame, min_words: int) -> DataFrame:
    """(rid, cuts): per document with any, its deleted stretches of lines
    [from, to), parted and in order."""
    lines = repeated_lines(docs)
    levels = suffix_levels(lines)
    singles = lines.where(F.col("words") >= min_words).select("pos", "first")
    runs = longest_copies(levels, singles)
    head = lines.select("pos", "rid", "start", F.col("cum").alias("from_cum"))
    tail = lines.select(F.col("pos").alias("tail"), (F.col("cum") + F.col("words")).alias("to_cum"))
    runs = runs.join(head, "pos").withColumn("tail", F.col("pos") + F.col("len") - 1).join(tail, "tail")
    runs = runs.where(F.col("to_cum") - F.col("from_cum") >= min_words).select(
        "rid", (F.col("pos") - F.col("start")).cast("int").alias("a"),
        (F.col("pos") - F.col("start") + F.col("len")).cast("int").alias("z"))
    order = Window.partitionBy("rid").orderBy("a", F.desc("z"))
    runs = runs.withColumn("reached", F.max("z").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    runs = runs.withColumn("island", F.count(F.when(F.col("reached").isNull() | (F.col("a") > F.col("reached")), 1)).over(order))
    merged = runs.groupBy("rid", "island").agg(F.min("a").alias("a"), F.max("z").alias("z"))
    return merged.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("a", "z"))).alias("cuts"))


def kept_text(text: Column, cuts: Column) -> Column:
    """``text`` without the lines of ``cuts``: the slices between them."""
    def keep(lines: Column) -> Column:
        starts_at = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda c: c["z"]))
        ends_at = F.concat(F.transform(cuts, lambda c: c["a"]), F.array(F.size(lines)))
        return F.array_join(F.flatten(F.zip_with(starts_at, ends_at, lambda s, e: F.slice(lines, s + 1, e - s))), "\n")
    # the outer array binds the split lines, so that they are split once
    return F.get(F.transform(F.array(F.split(text, "\n", -1)), keep), F.lit(0))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the later copies cut out of ``text_col``; ``counts``
    names two columns to add, the lines before and the lines deleted."""
    rows, rid = numbered(docs, "line-docs")
    plain = rows.select(F.col(rid).alias("rid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    plain = plain.withColumn("n", F.when(F.col("text").isNull(), 0).otherwise(_breaks("text") + 1))
    own = fresh(rows, "cuts")
    cuts = later_copies(plain, min_words).withColumnsRenamed({"rid": rid, "cuts": own})
    out = rows.join(cuts, rid, "left")
    text = F.when(F.col(own).isNull(), F.col(text_col)).otherwise(kept_text(F.col(text_col), F.col(own)))
    named = [text.alias(c) if c.lower() == text_col.lower() else F.col(c) for c in docs.columns]
    if counts:
        n = F.when(F.col(text_col).isNull(), 0).otherwise(_breaks(F.col(text_col)) + 1)
        gone = F.coalesce(F.aggregate(own, F.lit(0), lambda s, c: s + c["z"] - c["a"]), F.lit(0))
        named += [n.cast("long").alias(counts[0]), gone.cast("long").alias(counts[1])]
    return out.select(*named)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, counts=("n_lines", "n_deleted"))


#: Pairs of equal lines on one diagonal are a run; runs of enough words delete
#: their later side.
OP1_SQL = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS p, unnest(l) AS s
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
words AS (
  SELECT doc_id, p, s, trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t,
         len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS w FROM lines),
pairs AS (
  SELECT a.doc_id AS d0, b.doc_id AS d, b.p, b.p - a.p AS shift, b.w
  FROM words a JOIN words b ON a.t = b.t AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.p < b.p)),
runs AS (SELECT *, p - row_number() OVER (PARTITION BY d0, d, shift ORDER BY p) AS island FROM pairs),
long AS (SELECT d, p, sum(w) OVER (PARTITION BY d0, d, shift, island) AS total FROM runs),
gone AS (SELECT DISTINCT d AS doc_id, p FROM long WHERE total >= {MIN_WORDS}),
kept AS (
  SELECT w.doc_id, count(*) AS n_lines, count(g.p) AS n_deleted,
         coalesce(string_agg(w.s, chr(10) ORDER BY w.p) FILTER (WHERE g.p IS NULL), '') AS text
  FROM words w LEFT JOIN gone g USING (doc_id, p) GROUP BY w.doc_id)
SELECT d.doc_id, k.text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_deleted, 0)::BIGINT AS n_deleted
FROM documents d LEFT JOIN kept k USING (doc_id)"""

QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLE = {"op1_line_dedup": OP1_SQL}
