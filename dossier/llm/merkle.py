"""Merkle manifest of a dataset by bitmap ranks (operator 12).

Every row is a leaf; per group (source) the leaves stand in the order of their
ids and are hashed up by threes to a subroot, the subroots likewise to a root.
A leaf's place is its rank, found without sorting rows:

* Per group, ids become a bitmap of 64-bit words; only words with a bit exist,
  so it is compressed, whatever the spread of the ids. Partial bitmaps merge by
  bitwise or, map-side, and each word counts its rows beside.
* The popcount directory sums 1,024 words, then 1,024 such sums, as far as the
  ids' range asks for; each level adds what stands before within its 1,024.
* Rank query: rows before the word, and the bits below the id's own (one join on
  group and word). Words with repeated ids have more rows than bits; their rows
  alone are numbered in order (``ranking.ordered_index``).

Leaves then go to keyed slot arrays: a group of (group, rank / 3 ** 7) holds at
most 3 ** 7 of them, each in the slot its rank names, and gives its node seven
levels up; rounds repeat on the nodes until one is left. Going down again, each
block receives the siblings above it, so a leaf's proof and its folding need its
own block only. The text is read once, for the leaf's hash; what is shuffled is
ids and hashes. A group with a third of all rows is many blocks.

Inputs and their results: nulls of any column are hashed as ``-``, a null group
is a group of its own, before all others; null ids stand first in their group;
rows of equal id stand in the order of their leaves, equal rows each have a place
of their own; empty and very long texts count whole; an empty table gives an
empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.base import CRC_SQL, crc32_sql, stage, table
from dossier.operators.ranking import ordered_index

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node, and levels of a block: 3 ** 7 slots.
FAN, LEVELS = 3, 7
#: Words, or sums of a lower level, per sum of the popcount directory: 2 ** 10.
STEP = 10
#: The word of null ids, below that of any 64-bit id.
NULL_WORD = -(1 << 58)


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_rows(docs: DataFrame, id_col: str, group_col: str, fields: tuple[str, ...], text_col: str) -> DataFrame:
    """(tree, id, word, bit, leaf, tampered): the group as a string that sorts
    nulls first, the id's place in the bitmap, the leaf, and the leaf after
    tampering where that changes it."""
    def hashed(text: Column) -> Column:
        return F.sha2(F.concat(*[field(text if c == text_col else F.col(c)) for c in fields]), 256)

    text, i = F.col(text_col), F.col(id_col).cast("long")
    hit = (F.crc32(i.cast("string")) % 2 == 0) & (F.instr(text, "\n") > 0)
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(group_col).cast("string")), F.lit("n")).alias("tree"),
        F.col(id_col).alias("id"), F.coalesce(F.shiftright(i, 6), F.lit(NULL_WORD)).alias("word"),
        F.coalesce(i.bitwiseAND(F.lit(63)), F.lit(0)).cast("int").alias("bit"), hashed(text).alias("leaf"),
        F.when(hit, hashed(F.replace(text, F.lit("\n"), F.lit("")))).alias("tampered"))


def directory(sums: DataFrame, high: int) -> DataFrame:
    """``sums`` (tree, node, n, ...) with the rows ``before`` each node and the
    ``total`` of its tree; nodes lie between 0 and ``high``."""
    if high == 0:
        return sums.withColumn("before", F.lit(0).cast("long")).withColumn("total", F.col("n"))
    sums = sums.withColumn("parent", F.shiftright("node", STEP))
    inside = Window.partitionBy("tree", "parent").orderBy("node")  # 1,024 rows at most
    parents = stage(sums.groupBy("tree", "parent").agg(F.sum("n").alias("n")), "popcounts")
    above = directory(parents.withColumnRenamed("parent", "node"), high >> STEP)
    above = above.select("tree", F.col("node").alias("parent"), F.col("before").alias("above"), "total")
    here = sums.withColumn("inside", F.sum("n").over(inside) - F.col("n")).join(above, ["tree", "parent"])
    return stage(here.withColumn("before", F.col("above") + F.col("inside")).drop("parent", "inside", "above"), "directory")


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` with their rank ``pos`` in their tree and its ``total``."""
    low, high = leaves.agg(F.min("word"), F.max("word")).first()
    if low is None:
        return leaves.select("*", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("total"))
    node = (F.col("word") - F.lit(low)).alias("node")
    bitmap = stage(leaves.groupBy("tree", node).agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count(F.lit(1)).alias("n")), "bitmap")
    words = directory(bitmap, high - low).withColumn("word", F.col("node") + F.lit(low)).drop("node")
    found = leaves.join(words, ["tree", "word"])
    below = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)")))
    keep = [*leaves.columns, "total"]
    repeated = F.col("n") != F.bit_count("bits")
    alone = found.where(~repeated).select(*keep, (F.col("before") + below).alias("pos"))
    if bitmap.where(repeated).isEmpty():
        return alone
    ties = found.where(repeated).withColumn("row", F.monotonically_increasing_id())
    ties = ordered_index(ties, ["bit", "leaf", "row"], by=["tree", "word"], name="tie")
    return alone.unionByName(ties.select(*keep, (F.col("before") + F.col("tie")).alias("pos")))


def by_block(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FAN ** levels}"))


def height(total: int) -> int:
    """Levels from ``total`` leaves to one node."""
    levels, width = 0, 1
    while width < total:
        levels, width = levels + 1, width * FAN
    return levels


def slots(t: pa.Table, turn: int, per_block: int) -> tuple[list[list[str]], int]:
    """The levels of one block: its nodes in the slots that their places name,
    then level by level to the one that is left; and its first place."""
    pos, total = t.column("pos").to_pylist(), t.column("total")[0].as_py()
    first = pos[0] // FAN ** per_block * FAN ** per_block
    here: list[str] = [""] * len(pos)
    for p, x in zip(pos, t.column("hash").to_pylist(), strict=True):
        here[p - first] = x
    levels = [here]
    for _ in range(min(per_block, height(total) - turn * per_block)):
        here = [h("".join(here[i:i + FAN])) for i in range(0, len(here), FAN)]
        levels.append(here)
    return levels, first


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """What stands left and right of slot ``at`` in its run, per level."""
    out = []
    for here in levels[:-1]:
        run = at // FAN * FAN
        out += ["".join(here[run:at]), "".join(here[at + 1:run + FAN])]
        at //= FAN
    return out


def fold(start: str, path: list[str]) -> str:
    for i in range(0, len(path), 2):
        start = h(path[i] + start + path[i + 1])
    return start


def climbed(nodes: DataFrame, name: str, per_block: int) -> tuple[list[DataFrame], DataFrame]:
    """From ``nodes`` (tree, pos, total, hash) the rounds: ``nodes`` first, then
    the staged nodes ``per_block`` levels up of trees not yet at their root; and (tree, hash)
    of the roots."""
    def reduce(t: pa.Table) -> pa.Table:
        levels, first = slots(t, t.column("turn")[0].as_py(), per_block)
        return pa.table({"tree": t.column("tree").slice(0, 1), "pos": pa.array([first // FAN ** per_block], pa.int64()),
                         "total": t.column("total").slice(0, 1), "hash": pa.array(levels[-1])})

    rounds, roots = [], []
    top = nodes.agg(F.max("total")).first()[0] or 0
    for turn in range(max(1, -(-height(top) // per_block))):
        rounds.append(nodes)
        up = by_block(nodes.select("tree", "pos", "total", "hash", F.lit(turn).alias("turn")), per_block)
        up = up.groupBy("tree", "block")
        up = stage(up.applyInArrow(reduce, "tree string, pos long, total long, hash string"), f"{name}-{turn + 1}")
        done = F.col("total") <= FAN ** (per_block * (turn + 1))
        roots.append(up.where(done).select("tree", "hash"))
        nodes = up.where(~done)
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return rounds, out


def descended(rounds: list[DataFrame], paths: DataFrame, name: str, per_block: int) -> DataFrame:
    """(tree, block, path, subroot, root) per block of the lowest round, from
    ``paths`` (tree, path, subroot, root) of the trees' roots: the siblings of
    each node that stands above the leaves' blocks, level by level to the root."""
    def spread(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        levels, first = slots(left, left.column("turn")[0].as_py(), per_block)
        pos, above, n = left.column("pos").to_pylist(), right.column("path")[0].as_py(), left.num_rows
        return pa.table({
            "tree": pa.array([key[0].as_py()] * n), "block": pa.array(pos, pa.int64()),
            "path": pa.array([siblings(levels, p - first) + above for p in pos], pa.list_(pa.string())),
            "subroot": pa.array([right.column("subroot")[0].as_py()] * n),
            "root": pa.array([right.column("root")[0].as_py()] * n)})

    schema = "tree string, block long, path array<string>, subroot string, root string"
    out = paths.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
    for turn in range(len(rounds) - 1, 0, -1):
        own = by_block(rounds[turn], per_block).withColumn("turn", F.lit(turn))
        ends = out.join(own.select("tree").distinct(), "tree", "left_anti")  # trees that end below this round
        got = own.groupBy("tree", "block").cogroup(out.groupBy("tree", "block")).applyInArrow(
            lambda key, left, right: spread(key, left, right) if left.num_rows else EMPTY, schema)
        out = stage(got.unionByName(ends), f"{name}-down")
    return out


EMPTY = pa.table({"tree": pa.array([], pa.string()), "block": pa.array([], pa.int64()),
                  "path": pa.array([], pa.list_(pa.string())), "subroot": pa.array([], pa.string()),
                  "root": pa.array([], pa.string())})


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
             fields: tuple[str, ...] = FIELDS, text_col: str = "text", per_block: int = LEVELS) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root, verified) per row of
    ``docs``; proof is the siblings' hashes from the leaf's run to the root."""
    leaves = stage(leaf_rows(docs, id_col, group_col, fields, text_col), "leaves")
    placed = stage(ranked(leaves).select("tree", "pos", "total", "id", "leaf", "tampered"), "ranked")
    rounds, subroots = climbed(placed.withColumnRenamed("leaf", "hash"), "nodes", per_block)

    # the groups' own tree: their places are few rows, but as many as there are groups
    trees = ordered_index(subroots, ["tree"], name="pos")
    trees = trees.select(F.lit("top").alias("tree"), "pos", F.lit(trees.count()).cast("long").alias("total"), "hash",
                         F.col("tree").alias("member"))
    above, root = climbed(trees, "top", per_block)
    start = root.select("tree", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"),
                        F.col("hash").alias("root"))
    tops = descended(above, start, "top", per_block)

    def members(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        levels, first = slots(left, 0, per_block)
        pos, path, top = left.column("pos").to_pylist(), right.column("path")[0].as_py(), right.column("root")[0].as_py()
        return pa.table({"tree": left.column("member"), "path": pa.array(
            [siblings(levels, p - first) + path for p in pos], pa.list_(pa.string())), "subroot": left.column("hash"),
            "root": pa.array([top] * len(pos))})

    ends = stage(by_block(trees, per_block).groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInArrow(
        members, "tree string, path array<string>, subroot string, root string"), "subroots")
    blocks = descended(rounds, ends, "nodes", per_block)

    def prove(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        levels, first = slots(left, 0, per_block)
        pos, leaf = left.column("pos").to_pylist(), left.column("hash").to_pylist()
        path, n = right.column("path")[0].as_py(), len(pos)
        subroot, top = right.column("subroot")[0].as_py(), right.column("root")[0].as_py()
        rest, proofs, folded = "".join(path), [], []
        for p, own, changed in zip(pos, leaf, left.column("tampered").to_pylist(), strict=True):
            mine = siblings(levels, p - first)
            proofs.append("".join(mine) + rest)
            folded.append(fold(fold(own if changed is None else changed, mine), path))
        return pa.table([left.column("id"), left.column("hash"), pa.array([subroot] * n), pa.array([top] * n),
                         pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array([x == top for x in folded])],
                        names=schema.fieldNames())

    texts = [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof", "folded_root")]
    schema = T.StructType([placed.schema["id"], *texts, T.StructField("verified", T.BooleanType())])
    return by_block(placed.withColumnRenamed("leaf", "hash"), per_block).groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        prove, schema).withColumnRenamed("id", id_col)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = manifest(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
                      "verified")


def _sql_field(expr: str) -> str:
    return f"coalesce(strlen({expr}::VARCHAR)::VARCHAR || ':' || {expr}::VARCHAR, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(text if c == "text" else c) for c in FIELDS) + ")"


#: All levels of all trees, then of the subroots' tree; a leaf's run per level.
OP12_SQL = f"""
WITH RECURSIVE {CRC_SQL},
docs AS (SELECT doc_id, source, CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '')
  ELSE text END AS changed, lang, n_chars,
  {_sql_leaf('text')} AS leaf FROM documents, steps),
leaves AS (SELECT doc_id, coalesce('s' || source, 'n') AS tree, leaf, {_sql_leaf('changed')} AS tampered,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM docs),
low AS (SELECT tree, 0 AS lvl, pos, n, leaf AS hash FROM leaves UNION ALL
  SELECT tree, lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(hash, '' ORDER BY pos)) FROM low WHERE n > 1
  GROUP BY tree, lvl, pos // 3),
subroots AS (SELECT tree, hash, lvl FROM low WHERE n = 1),
high AS (SELECT 0 AS lvl, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, hash FROM subroots UNION ALL
  SELECT lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(hash, '' ORDER BY pos)) FROM high WHERE n > 1
  GROUP BY lvl, pos // 3),
places AS (SELECT tree, hash AS subroot, lvl AS top, row_number() OVER (ORDER BY tree) - 1 AS place FROM subroots),
runs AS (SELECT tree, lvl, pos // 3 AS run, list(hash ORDER BY pos) AS l FROM low WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT p.tree, p.top + h.lvl, h.pos // 3, list(h.hash ORDER BY h.pos) FROM high h, places p
  WHERE h.n > 1 AND h.pos // 3 = p.place // (3 ** (h.lvl + 1))::BIGINT GROUP BY ALL),
walk AS (SELECT tree, pos AS leaf_pos, pos, 0 AS lvl, tampered AS hash, '' AS proof FROM leaves UNION ALL
  SELECT w.tree, leaf_pos, CASE WHEN w.lvl + 1 = p.top THEN p.place ELSE w.pos // 3 END, w.lvl + 1,
    sha256(array_to_string(l[1:w.pos % 3], '') || w.hash || array_to_string(l[w.pos % 3 + 2:], '')),
    proof || array_to_string(l[1:w.pos % 3], '') || array_to_string(l[w.pos % 3 + 2:], '')
  FROM (SELECT w.tree, leaf_pos, lvl, hash, proof, CASE WHEN w.lvl = 0 AND p.top = 0 THEN p.place ELSE w.pos END AS pos
        FROM walk w JOIN places p ON w.tree = p.tree) w
  JOIN places p ON w.tree = p.tree JOIN runs r ON r.tree = w.tree AND r.lvl = w.lvl AND r.run = w.pos // 3),
last AS (SELECT tree, leaf_pos, max(lvl) AS m, arg_max(hash, lvl) AS folded, arg_max(proof, lvl) AS proof FROM walk
  GROUP BY tree, leaf_pos),
root AS (SELECT hash AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves l JOIN last ON l.tree = last.tree AND l.pos = last.leaf_pos JOIN places p ON p.tree = l.tree, root"""

QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
ORACLE = {"op12_merkle_manifest": OP12_SQL}
