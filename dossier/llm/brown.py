"""Class-based bigram scores with exchange clustering (operator 4).

P(word | before) = P(class | class before) * P(word | class). Documents whose
crc32(id) modulo 7 is not 2 are learned from, every document is scored.

**Counting.** A task reads texts into *chunks* of bounded vocabulary: a
document becomes numbers of its chunk's own word list, the list goes along
with the chunk's counts, both in one staged table. Lists are shuffled by word
to get each word's count in the whole corpus, and back by chunk to meet their
documents. So counts are exact for every word, no task holds more than a
chunk's words, and what moves grows with the input, word by word only once a
chunk however often a word occurs in it.

**Classes.** Every training word is clustered by its own neighbours. To start
with, words are dealt to units by their last ``SUFFIX`` bytes, a number that a
task knows without the rest of the corpus, and exchange clustering moves one unit
at a time to the class that raises the likelihood of the class bigrams most, until
a round moves none (or ``ROUNDS``); it runs on the table of unit pairs, whose size
is fixed by ``UNITS`` (some 13 MB), not by the corpus. Then each word, frequent or
rare, leaves its unit: a list has, per word, how often each unit stands before
and after it in the chunk's training text (``near``); summed up over all chunks
these give the likelihood of the word in each class, and it moves to the best.
All words move at once, by the table of before. The end keeps its class, and a
word that no training text has, so without neighbours, that of its unit.

**Smoothing.** A word of class c has (its count + 1) / (tokens of c + words of
c + 1), where the last 1 is for all unseen words; a class transition is mixed
with the class's own share as if that had been seen ``PRIOR`` times. The end
stands before the first word.

Inputs and their results: a null or empty text, or one of white space, is the
end alone; very long texts are one document of a chunk; repeated rows are
counted and scored each; a null id is learned from; with nothing learned the base score is 0; an empty table
gives an empty one; other columns are neither read nor returned.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.base import fold, stage, table

#: Units that words start in, that of the end included, and the bytes that choose one.
UNITS, SUFFIX = 1280, 3
CLASSES, ROUNDS, PRIOR = 64, 12, 20.0
#: A chunk ends with the document that brings it to so many words or tokens.
CHUNK_WORDS, CHUNK_TOKENS = 300_000, 4_000_000
HELD_OUT, FOLDS = 2, 7
#: The end of a text, as a word: no word is empty.
END = b""
#: ``near`` has numbers of two bytes: a unit, ``UNITS`` more if it stands after the
#: word, times 16, and the exponent of a power of two; a count is a sum of these.
TOP = 15
#: Rows of word, side and class that are weighed at once.
WEIGHED = 50_000


def unit_of(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX:]) % (UNITS - 1) + 1 if word else 0


def powers(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, exponent) of the powers of two that ``counts`` are sums of, by place."""
    places = [np.flatnonzero(counts >> e & 1) for e in range(TOP)]
    places.append(np.repeat(np.arange(len(counts)), counts >> TOP))
    exponents = np.repeat(np.arange(TOP + 1), [len(p) for p in places])
    place = np.concatenate(places)
    order = np.argsort(place, kind="stable")
    return place[order], exponents[order]


def nearby(ids: np.ndarray, before: np.ndarray, unit: np.ndarray) -> pa.Array:
    """``near`` of each word number, from the training text ``ids`` and what stands before each."""
    words, codes = [], []
    small = np.uint32 if len(unit) * UNITS < 2 ** 32 else np.int64
    for side, (word, other) in enumerate(((ids, before), (before, ids))):
        key, n = np.unique(word.astype(small) * small(UNITS) + unit[other].astype(small), return_counts=True)
        place, exponent = powers(n)
        key = key[place].astype(np.int64)
        words.append(key // UNITS)
        codes.append(((key % UNITS + side * UNITS) * (TOP + 1) + exponent).astype("<u2"))
    word, code = np.concatenate(words), np.concatenate(codes)
    code = code[np.argsort(word, kind="stable")]
    offsets = np.append(0, np.cumsum(np.bincount(word, minlength=len(unit)))).astype(np.int32) * 2
    return pa.Array.from_buffers(pa.binary(), len(unit), [None, pa.py_buffer(offsets), pa.py_buffer(code.tobytes())])


class Chunk:
    """Documents as numbers of a growing word list."""

    def __init__(self):
        self.name = uuid.uuid4().int >> 66
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.tokens = 0
        self.learned: list[np.ndarray] = []

    def add(self, text: str, held_out: bool) -> bytes:
        words = text.encode().lower().split()
        words.append(END)
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        self.tokens += len(ids)
        if not held_out:
            self.learned.append(ids)
        return ids.tobytes()

    def full(self) -> bool:
        return len(self.numbers) >= CHUNK_WORDS or self.tokens >= CHUNK_TOKENS

    def counts(self) -> Iterator[pa.RecordBatch]:
        """The words with their neighbours, and the pairs of neighbouring units, of the training text."""
        ids = np.concatenate(self.learned) if self.learned else np.zeros(0, np.int32)
        n = np.bincount(ids, minlength=len(self.numbers))
        before = np.append(ids[-1:], ids[:-1])  # every text ends in the end
        unit = np.fromiter(map(unit_of, self.numbers), np.int64, len(n))
        yield pa.RecordBatch.from_arrays([
            pa.array([self.name] * len(n), pa.int64()), pa.array(list(self.numbers), pa.binary()),
            pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n), nearby(ids, before, unit)],
            ["chunk", "word", "number", "n", "near"])
        pairs = np.bincount(unit[before] * UNITS + unit[ids], minlength=1)
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(at // UNITS), pa.array(at % UNITS), pa.array(pairs[at])], ["a", "b", "n"])


def filled(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """``batch`` with nulls for the columns of ``schema`` that it lacks."""
    names = batch.schema.names
    return pa.RecordBatch.from_arrays([
        batch.column(f.name) if f.name in names else pa.nulls(batch.num_rows, f.type) for f in schema], schema=schema)


def chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Staged rows of three kinds: documents (chunk, id, held_out, ids), the words
    of chunks (chunk, word, number, n, near) and their pairs of units (a, b, n)."""
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    schema = T.StructType([T.StructField("chunk", T.LongType()), id_field, T.StructField("held_out", T.BooleanType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("word", T.BinaryType()),
                           T.StructField("number", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("near", T.BinaryType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        chunk = Chunk()
        for b in batches:
            texts, held = b.column("text").to_pylist(), b.column("held_out").to_pylist()
            at = 0
            while at < len(texts):
                first, ids = at, []
                while at < len(texts) and not chunk.full():
                    ids.append(chunk.add(texts[at] or "", held[at]))
                    at += 1
                yield filled(pa.RecordBatch.from_arrays(
                    [pa.array([chunk.name] * len(ids), pa.int64()), b.column("id").slice(first, at - first),
                     b.column("held_out").slice(first, at - first), pa.array(ids, pa.binary())],
                    ["chunk", "id", "held_out", "ids"]), arrow)
                if chunk.full():
                    yield from (filled(x, arrow) for x in chunk.counts())
                    chunk = Chunk()
        if chunk.tokens:
            yield from (filled(x, arrow) for x in chunk.counts())

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(fold(id_col, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"))
    return stage(rows.mapInArrow(run, schema), "chunks")


def counted(chunks: DataFrame) -> DataFrame:
    """What chunks have counted: words (chunk, number, word, n, near) and pairs of units (a, b, n)."""
    return chunks.where("ids is null").select("chunk", "number", "word", "n", "near", "a", "b")


def nlogn(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def grown(table: np.ndarray, row: np.ndarray, n: np.ndarray, home: np.ndarray) -> np.ndarray:
    """For each of ``row`` and ``n``, what n log n of the cells of that row of
    ``table`` gains by n more; in the cell ``home``, by the n that it has already."""
    key, at = np.unique(n * len(table) + row, return_inverse=True)
    was, more = table[key % len(table)], (key // len(table))[:, None]
    out = (nlogn(was + more) - nlogn(was))[at]
    each = np.arange(len(row))
    own = table[row, home]
    out[each, home] = nlogn(own) - nlogn(np.maximum(own - n, 0))
    return out


def best_classes(table: np.ndarray, home: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The class of each word that raises the likelihood of the class bigrams
    ``table`` most, its own neighbours (``near``: word x side x class) taken
    from ``home``; that one where none is better."""
    gain = np.zeros((len(home), len(table)))
    for side, cells in enumerate((table, table.T)):
        counts = near[:, side]
        word, other = np.nonzero(counts)
        for s in range(0, len(word), WEIGHED):
            w, o = word[s:s + WEIGHED], other[s:s + WEIGHED]
            starts = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            gain[w[starts]] += np.add.reduceat(grown(cells, o, counts[w, o], home[w]), starts)
        margin = cells.sum(axis=0, keepdims=True)
        gain -= grown(np.repeat(margin, len(table), axis=0), np.zeros(len(home), np.int64), counts.sum(axis=1), home)
    best, each = gain.argmax(axis=1), np.arange(len(home))
    own = gain[each, home]
    return np.where(gain[each, best] > own + 1e-9 * np.abs(own), best, home)


def with_units(counts: DataFrame) -> DataFrame:
    """Staged (chunk, number, total, first, unit) per word of a chunk: its count in all
    training text, whether it is the one row of the word that is marked, and its class."""
    cells = counts.where("a is not null").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros((UNITS, UNITS))
    pairs[cells.column("a").to_numpy(), cells.column("b").to_numpy()] = cells.column("n").to_numpy()
    of = exchange(pairs, CLASSES, ROUNDS)
    member = np.eye(CLASSES)[of]
    table = member.T @ pairs @ member

    def weighed(b: pa.RecordBatch) -> pa.RecordBatch:
        listed = b.column("word").dictionary_encode()
        at, words = listed.indices.to_numpy().astype(np.int64), listed.dictionary.to_pylist()
        total = np.bincount(at, b.column("n").to_numpy(), len(words)).astype(np.int64)
        parts = b.column("near").to_pylist()
        code = np.frombuffer(b"".join(parts), "<u2").astype(np.int64)
        word = np.repeat(at, [len(p) // 2 for p in parts])
        slot, n = code // (TOP + 1), 1 << code % (TOP + 1)
        key = (word * 2 + slot // UNITS) * CLASSES + of[slot % UNITS]
        near = np.bincount(key, n, len(words) * 2 * CLASSES).astype(np.int64).reshape(-1, 2, CLASSES)
        home = of[np.fromiter(map(unit_of, words), np.int64, len(words))]
        unit = best_classes(table, home, near)
        if words[0] == END:
            unit[0] = home[0]
        return pa.RecordBatch.from_arrays([
            b.column("chunk"), b.column("number"), pa.array(total[at]), pa.array(np.append(True, at[1:] != at[:-1])),
            pa.array(unit[at].astype(np.int32))], ["chunk", "number", "total", "first", "unit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of the last word, which may go on
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            at = b.column("word").dictionary_encode().indices.to_numpy()
            cut = int(np.searchsorted(at, at[-1]))
            if cut:
                yield weighed(b.slice(0, cut))
            held = b.slice(cut)
        if held is not None:
            yield weighed(held)

    words = counts.where("word is not null").select("chunk", "number", "word", "n", "near")
    return stage(words.repartition("word").sortWithinPartitions("word").mapInArrow(
        run, "chunk long, number int, total long, first boolean, unit int"), "word-counts")


def looked_up(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """Staged rows of two kinds: documents (id, held_out, n_tokens, n_known,
    log_counts: the sum of log10(count + 1), units: the class of each word) and the
    pairs of neighbouring classes of a chunk's training text (a, b, n)."""
    schema = T.StructType([chunks.schema["id"], T.StructField("held_out", T.BooleanType()),
                           *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")),
                           T.StructField("log_counts", T.DoubleType()), T.StructField("units", T.BinaryType()),
                           *(T.StructField(c, T.LongType()) for c in ("a", "b", "n"))])

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, listed: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        number = listed.column("number").to_numpy()
        total, unit = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        total[number], unit[number] = listed.column("total").to_numpy(), listed.column("unit").to_numpy()
        parts = docs.column("ids").to_pylist()
        ids = np.frombuffer(b"".join(parts), np.int32)
        ends = np.cumsum([len(p) // 4 for p in parts])
        starts = np.append(0, ends[:-1])
        units = unit[ids]
        before = np.append(units[-1:], units[:-1])  # every text ends in the end
        learn = np.repeat(~np.array(docs.column("held_out").to_pylist(), bool), ends - starts)
        pairs = np.bincount(before[learn] * CLASSES + units[learn], minlength=1)
        at = np.flatnonzero(pairs)
        small = units.astype(np.uint8).tobytes()
        rows = pa.RecordBatch.from_arrays([
            docs.column("id").combine_chunks(), docs.column("held_out").combine_chunks(), pa.array(ends - starts),
            pa.array(np.add.reduceat((total[ids] > 0).astype(np.int64), starts)),
            pa.array(np.add.reduceat(np.log10(total + 1.0)[ids], starts)),
            pa.array([small[s:e] for s, e in zip(starts.tolist(), ends.tolist())], pa.binary())],
            ["id", "held_out", "n_tokens", "n_known", "log_counts", "units"])
        cells = pa.RecordBatch.from_arrays([pa.array(at // CLASSES), pa.array(at % CLASSES), pa.array(pairs[at])], ["a", "b", "n"])
        arrow = to_arrow_schema(schema)
        return pa.Table.from_batches([filled(rows, arrow), filled(cells, arrow)])

    docs = chunks.where("ids is not null").select("chunk", "id", "held_out", "ids")
    lists = words.select("chunk", "number", "total", "unit")
    return stage(docs.groupBy("chunk").cogroup(lists.groupBy("chunk")).applyInArrow(run, schema), "unit-texts")


def exchange(pairs: np.ndarray, classes: int, rounds: int) -> np.ndarray:
    """Class of each unit, from the counts of unit pairs. Units start out
    dealt by frequency; each moves in turn where the likelihood of the class
    bigrams, sum n log n over pairs less both margins, grows most."""
    size = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-size, kind="stable")
    of = np.empty(len(pairs), np.int64)
    of[order] = np.arange(len(pairs)) % classes
    member = np.zeros((len(pairs), classes))
    member[np.arange(len(pairs)), of] = 1
    table = member.T @ pairs @ member

    for _ in range(rounds):
        moved = 0
        for u in order[size[order] > 0]:
            own = pairs[u, u]
            out = np.bincount(of, pairs[u], classes)  # from u to each class, u itself apart
            into = np.bincount(of, pairs[:, u], classes)
            out[of[u]] -= own
            into[of[u]] -= own
            home = of[u]
            # the table without u
            table[home] -= out
            table[:, home] -= into
            table[home, home] -= own
            row, col = table.sum(axis=1), table.sum(axis=0)
            # for each class c: what its row and column gain with u in it
            gain = (nlogn(table + out) - nlogn(table)).sum(axis=1) + (nlogn(table + into[:, None]) - nlogn(table)).sum(axis=0)
            both = np.diag(table)
            cross = both + out + into + own
            gain += nlogn(cross) - nlogn(both) - (nlogn(both + out) - nlogn(both)) - (nlogn(both + into) - nlogn(both))
            u_out, u_in = out.sum() + own, into.sum() + own
            gain -= nlogn(row + u_out) - nlogn(row) + nlogn(col + u_in) - nlogn(col)
            best = int(np.argmax(gain))
            if gain[best] <= gain[home] + 1e-9 * abs(gain[home]):
                best = home
            table[best] += out
            table[:, best] += into
            table[best, best] += own
            of[u] = best
            moved += best != home
        if not moved:
            break
    return of


@dataclass
class Model:
    tokens: int
    words: int
    classes: np.ndarray  # of units: each word's is its class
    transitions: np.ndarray  # log10 P(class | class before)
    emission: np.ndarray  # log10 of each class's denominator

    def score(self, units: np.ndarray) -> float:
        """log10 probability of a text but for the counts of its words."""
        of = self.classes[units]
        return float(self.transitions[np.append(of[-1:], of[:-1]), of].sum() - self.emission[of].sum())


def trained(words: DataFrame, texts: DataFrame) -> Model:
    sizes = words.where(F.col("first") & (F.col("total") > 0)).groupBy("unit").agg(
        F.sum("total").alias("tokens"), F.count("*").alias("words")).collect()
    size, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sizes:
        size[r.unit], kinds[r.unit] = r.tokens, r.words
    cells = texts.where("a is not null").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((CLASSES, CLASSES))
    table[cells.column("a").to_numpy(), cells.column("b").to_numpy()] = cells.column("n").to_numpy()
    share = (size + 1) / (size.sum() + CLASSES)
    transitions = np.log10((table + PRIOR * share) / (table.sum(axis=1, keepdims=True) + PRIOR))
    return Model(int(size.sum()), int(kinds.sum()), np.arange(CLASSES), transitions, np.log10(size + kinds + 1))


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) per row."""
    chunks = chunked(docs, id_col, text_col)
    words = with_units(counted(chunks))
    texts = looked_up(chunks, words)
    model = trained(words, texts)
    names = ["id", "held_out", "n_tokens", "n_known", "log_counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rest = [model.score(np.frombuffer(u, np.uint8)) for u in b.column("units").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(rest, pa.float64())], [*names, "rest"])

    schema = T.StructType([*(texts.schema[c] for c in names), T.StructField("rest", T.DoubleType())])
    out = texts.where("units is not null").select(*names, "units").mapInArrow(run, schema)
    base = F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(model.tokens + model.words + 1.0))
    score = F.col("log_counts") + F.col("rest")
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"),
                      F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"))


def op4_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))


QUERIES = {"op4_brown_classes": op4_brown_classes}
ORACLE: dict[str, str] = {}
