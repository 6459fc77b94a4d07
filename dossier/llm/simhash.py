"""SimHash near-duplicates (operator 8).

A fingerprint has a bit set where over half of the hashes of the text's word
shingles have it. Fingerprints that differ in at most ``max_bits`` bits link;
a component is what links reach.

**Candidates by the pigeonring principle.** The 64 bits are cut into
``segments`` boxes on a ring. If two fingerprints differ in at most t bits in
all, then from some box on, every run of l consecutive boxes holds at most
l * t / segments differences. The first boxes of that chain must be equal
(their budget is below 1), so they are a join key; the longer chains are
checked as filters, and the last of them, all the way round, is the full
Hamming test.

**Large groups.** Only distinct fingerprints are joined, so exact copies cost
one row. A key that more than ``bucket`` fingerprints share is not paired up:
each of its fingerprints emits its variants (some free bits flipped), and all
that meet in a variant link to the smallest of them. Two fingerprints within t
bits always meet half way, and what meets half way is within t bits, so this
is exact too, with rows in proportion to the group instead of its square.

Inputs and their results: a null or empty text, or one of white space only,
has fingerprint zero and links like any other; a text of fewer words than a
shingle is one shingle; repeated rows are kept and share a component; a null
id never names a component unless all its ids are null; an empty table gives
an empty one; other columns are neither read nor returned.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.base import numbered, stage, table

BITS = 64
#: Shingles whose hash bits are counted at once.
BLOCK = 1 << 16


def simhash(words: list[bytes], shingle: int) -> int:
    """The fingerprint, as a signed 64-bit number, of a word sequence."""
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        spans = [(0, len(text))]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        spans = list(zip((ends - lengths)[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(spans), BLOCK):
        digests = b"".join([xxhash.xxh64_digest(text[a:b], 42) for a, b in spans[at:at + BLOCK]])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(spans)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text_col: str, shingle: int, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``fp`` per row. One pass over the text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [simhash((t or "").encode().lower().split(), shingle) for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(fps, pa.int64())], [*keep, "fp"])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("fp", T.LongType())])
    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(run, schema)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def rings(segments: int, max_bits: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Per start box: the mask of the boxes that must be equal, and the chain
    as (mask, budget) pairs, up to the whole ring."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    box = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(segments)]
    out = []
    for start in range(segments):
        key, chain, mask = 0, [], 0
        for length in range(1, segments + 1):
            mask |= box[(start + length - 1) % segments]
            budget = length * max_bits // segments
            if budget == 0:
                key = mask
            elif not chain or chain[-1][1] < budget or length == segments:
                chain.append((mask, budget))
            else:  # same budget over more boxes: the wider test holds the narrower
                chain[-1] = (mask, budget)
        out.append((key, chain))
    return out


def links(fps: DataFrame, max_bits: int, segments: int = 5, bucket: int = 64) -> DataFrame:
    """Edges (a, b), a < b, between the distinct ``fp`` of ``fps``: enough of
    the pairs within ``max_bits`` bits that their components are those of all
    such pairs, and no pair beyond."""
    if not 0 < max_bits < segments:
        raise ValueError("needs 0 < max_bits < segments, so that each chain starts with an equal box")
    ring = rings(segments, max_bits)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_signed(key))).alias("k"))
        for i, (key, _) in enumerate(ring)])).alias("s")).select("fp", "s.i", "s.k")
    sizes = keyed.groupBy("i", "k").agg(F.count("*").alias("n")).where("n > 1")
    keyed = stage(keyed.join(sizes, ["i", "k"]), "simhash-keys")

    few = keyed.where(F.col("n") <= bucket).select("i", "k", "fp")
    a, b = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    chained: Column = F.lit(False)
    for i, (_, chain) in enumerate(ring):
        viable: Column = F.col("i") == i
        for mask, budget in chain:
            viable = viable & (F.bit_count(diff.bitwiseAND(F.lit(_signed(mask)))) <= budget)
        chained = chained | viable
    paired = a.join(b, ["i", "k"]).where((F.col("a") < F.col("b")) & chained).select("a", "b")

    return paired.unionByName(_stars(keyed.where(F.col("n") > bucket), ring, max_bits)).distinct()


def _stars(keyed: DataFrame, ring: list, max_bits: int) -> DataFrame:
    """Edges within the keys of many fingerprints, by shared variants."""
    far, near = math.ceil(max_bits / 2), max_bits // 2

    def variants(key: int, flips: int) -> list[int]:
        free = [1 << j for j in range(BITS) if not key >> j & 1]
        return [_signed(sum(c)) for n in range(flips + 1) for c in itertools.combinations(free, n)]

    def flipped(flips: int) -> DataFrame:
        masks = F.array(*[F.array(*map(F.lit, variants(key, flips))) for key, _ in ring])
        return keyed.select("i", "fp", F.explode(F.get(masks, F.col("i"))).alias("m")).select(
            "i", "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("v"))

    hub = flipped(near).groupBy("i", "v").agg(F.min("fp").alias("hub"))
    met = flipped(far).join(hub, ["i", "v"]).where(F.col("fp") != F.col("hub"))
    return met.select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that edges (a, b) reach, for every node
    that has one. Alternates large-star and small-star steps until nothing
    changes; each step is staged, so lineage stays short."""
    edges = stage(edges.where("a < b").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.least("a", "m").alias("a"), "b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        edges = stage(small.select(F.col("m").alias("a"), "b")
                      .union(small.where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b")))
                      .distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = now


def grouped(rows: DataFrame, max_bits: int, segments: int = 5) -> DataFrame:
    """(fp, root) for every distinct ``fp`` of ``rows``."""
    nodes = rows.select("fp").distinct()
    found = components(links(nodes, max_bits, segments))
    return nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, segments: int = 5) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``."""
    rows = stage(fingerprints(docs.select(id_col, text_col), text_col, shingle, [id_col]), "fingerprints")
    least = rows.groupBy("fp").agg(F.min(id_col).alias("least"))
    of = grouped(rows, max_bits, segments).join(least, "fp")
    named = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(of.join(named, "root").select("fp", "component_id"), "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         max_bits: int = 2, segments: int = 5) -> DataFrame:
    """The rows of ``docs`` without later near copies: of each component the
    row with the smallest id stays (nulls last, then the first row)."""
    docs_n, rid = numbered(docs, "simhash-docs")
    rows = fingerprints(docs_n.select(id_col, text_col, rid), text_col, shingle, [id_col, rid])
    rows = stage(rows.select(F.col(id_col).alias("id"), F.col(rid).alias("rid"), "fp"), "fingerprints")
    order = F.struct(F.isnull("id").alias("none"), "id", "rid")
    first = rows.groupBy("fp").agg(F.min(order).alias("o"))
    stay = grouped(rows, max_bits, segments).join(first, "fp").groupBy("root").agg(F.min("o").alias("o"))
    # a row a component: not bounded, so never broadcast
    stay = stay.select(F.col("o.rid").alias(rid)).hint("merge")
    return docs_n.join(stay, rid, "left_semi").select(*docs.columns)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


QUERIES = {"op8_simhash_near_dedup": op8_simhash_near_dedup}
ORACLE: dict[str, str] = {}
