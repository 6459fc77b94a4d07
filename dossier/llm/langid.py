"""Language identification by cross-parsing (operator 9).

Per language, a bounded sample of labelled text becomes a suffix automaton,
which reads exactly the substrings of the sample. A text is parsed against
each: from where the last phrase ended, take the longest match with any part
of the sample, and start anew. The number of phrases, times the logarithm of
the sample's size, per character, is the cross-parsing entropy; the language
with the least wins. The score says how clearly: 1 / (1 + 2^(-gap)) summed
over the languages, where gap is the difference of the code lengths per
``SPAN`` characters.

**How it runs.** One Spark task per language builds the automaton and turns it
into a table (state, letter) -> next state, in which a missing letter leads
where the next phrase begins, with a mark. Texts are cut into blocks of
``BLOCK`` characters (a phrase never crosses a block) and all blocks of a
batch advance together, one letter a step, by array lookups. Tables are
broadcast: their size is languages x ``SAMPLE`` characters x ``DENSE`` letters,
whatever the corpus and the script; rarer letters keep only the transitions
that exist. Up to ``MAX_LANGUAGES`` learned languages take one pass; more are
taken in groups of so many, one group's tables in memory at a time: the texts
are staged with a row number, each pass adds a row's best language and the sum
of its score, and these are merged by row. Whole texts count.

Learning reads only rows with a language and a remainder of crc32(id) modulo 3
other than 1. The sample takes about ``PARTS`` texts drawn by hash, of each ``PART``
characters at a place that its hash gives, so that neither a single document
nor what all begin with fills it, up to ``SAMPLE`` characters.

Inputs and their results: null or empty texts and those without a letter are
``und`` with score 0, whatever marks, symbols or digits they have; very long texts are parsed whole; repeated rows get the
same result and count once in the sample; a null id is neither learned from
nor held out; languages of equal entropy go by name; with nothing to learn
from every text is ``und``; an empty table gives an empty one; other columns
are neither read nor returned.
"""

from __future__ import annotations

import functools
import pickle
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.base import count_over, fold, numbered, stage, table

SAMPLE, PART, PARTS = 40_000, 2000, 800
BLOCK, AT_ONCE, SPAN = 1024, 4096, 100
#: Letters of a language with a table column of their own.
DENSE = 64
#: Languages whose tables are in memory at a time: each takes 25 MB of a Python worker at most.
MAX_LANGUAGES = 30
#: So many languages are few enough to broadcast their counts.
FEW = 100_000
HELD_OUT, FOLDS = 1, 3
UNKNOWN = "und"
#: A letter that the sample lacks, the break between words, and the first letter.
MISSING, BREAK, FIRST = 0, 1, 2
#: A transition's upper bits hold the phrases that it completes.
SHIFT = 28
TABLE_END = 0x110000


def lowered() -> tuple[np.ndarray, np.ndarray]:
    """Code point to that of its lower-case letter, the break for all but
    letters and their marks; and whether it is a letter."""
    out = np.full(TABLE_END, BREAK, np.uint32)
    letter = np.zeros(TABLE_END, bool)
    for c in range(TABLE_END):
        kind = unicodedata.category(ch := chr(c))[0]
        if kind in "LM":
            out[c] = ord(ch.lower()[0])
            letter[c] = kind == "L"
    return out, letter


class Folder:
    """The lazily built tables, once per process."""
    tables: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def read(cls, text: str) -> tuple[np.ndarray, bool]:
        """The text's folded letters, and whether it has any."""
        if cls.tables is None:
            cls.tables = lowered()
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        return cls.tables[0][points], bool(cls.tables[1][points].any())

    @classmethod
    def codes(cls, text: str) -> np.ndarray:
        return cls.read(text)[0]


def automaton(letters: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in letters:
        cur = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return moves


class Parser:
    """Counts the phrases of texts against one sample. The ``DENSE`` most
    frequent letters have a table column each; of the others, a script of
    thousands may have many, only the transitions that exist are kept, sorted by
    (state, letter), so memory follows the sample and not the alphabet."""

    def __init__(self, letters: np.ndarray):
        found, times = np.unique(letters[letters != BREAK], return_counts=True)
        self.alphabet = found
        #: Per place in the alphabet the letter's code, the most frequent first.
        self.code = np.empty(len(found), np.int32)
        self.code[np.lexsort((found, -times))] = np.arange(FIRST, FIRST + len(found), dtype=np.int32)
        self.size = FIRST + len(found)
        self.width = FIRST + min(DENSE, len(found))
        self.bits = np.log2(max(2, len(letters)))
        moves = automaton(self.coded(letters).tolist())
        start = np.zeros(self.size, np.int32)
        for c, to in moves[0].items():
            start[c] = to
        # a letter that doesn't go on completes the phrase; an unknown letter is one of its own
        unknown = start == 0
        self.anew = start + ((1 + unknown.astype(np.int32)) << SHIFT)
        self.table = np.tile(self.anew[:self.width], (len(moves), 1))
        self.table[0, unknown[:self.width]] = 1 << SHIFT
        rare: list[tuple[int, int]] = []
        for state, row in enumerate(moves):
            for c, to in row.items():
                if c < self.width:
                    self.table[state, c] = to
                else:
                    rare.append((state * self.size + c, to))
        self.table = self.table.ravel()
        rare.sort()
        # one more key than any there is, so that every search ends at one
        self.keys = np.array([k for k, _ in rare] + [np.iinfo(np.int64).max], np.int64)
        self.goes = np.array([to for _, to in rare] + [0], np.int32)

    def coded(self, letters: np.ndarray) -> np.ndarray:
        if not len(self.alphabet):
            return np.where(letters == BREAK, BREAK, MISSING).astype(np.int32)
        at = np.minimum(np.searchsorted(self.alphabet, letters), len(self.alphabet) - 1)
        return np.where(letters == BREAK, BREAK, np.where(self.alphabet[at] == letters, self.code[at], MISSING)).astype(np.int32)

    def step(self, state: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where each state goes with its letter, phrases completed in the upper bits."""
        if self.size == self.width:
            return self.table[state * self.width + row]
        rare = row >= self.width
        to = self.table[state * self.width + np.where(rare, 0, row)]
        some = np.flatnonzero(rare)
        if len(some):
            keys = state[some].astype(np.int64) * self.size + row[some]
            at = np.searchsorted(self.keys, keys)
            to[some] = np.where(self.keys[at] == keys, self.goes[at], self.anew[row[some]])
        return to

    def phrases(self, columns: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per block: ``columns[i]`` is the i-th letter of all blocks, longest
        block first; a block ends after ``lengths`` letters."""
        state = np.zeros(len(lengths), np.int32)
        count = np.zeros(len(lengths), np.int64)
        live = np.searchsorted(-lengths, -np.arange(1, len(columns) + 1), side="right")
        for row, n in zip(columns, live):
            to = self.step(state[:n], row[:n])
            count[:n] += to >> SHIFT
            state[:n] = to & ((1 << SHIFT) - 1)
        return count + (state > 0)


def samples(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, h, text): distinct parts drawn by their hash, about SAMPLE
    characters a language. Only hashes of all rows are shuffled."""
    learn = docs.where((fold(id_col, FOLDS) != HELD_OUT) & F.col(lang_col).isNotNull())
    places = F.greatest(F.length(text_col) - PART, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64(text_col), places) + 1).cast("int")
    parts = learn.select(F.col(lang_col).alias("lang"), F.substring(text_col, start, F.lit(PART)).alias("text"))
    parts = parts.where("text != ''").withColumn("h", F.xxhash64("text"))
    # the share of the hash range that holds about PARTS distinct parts
    counts = stage(parts.groupBy("lang").agg(F.count_distinct("h").alias("n")).select(
        "lang", F.least(F.lit(1.0), F.lit(PARTS) / F.col("n")).alias("share")), "languages")
    few = not count_over(docs.sparkSession, counts, FEW)
    drawn = F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30)
    chosen = parts.join(F.broadcast(counts) if few else counts, "lang").where(drawn).groupBy("lang", "h").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("h")
    before = F.sum(F.length("text")).over(order) - F.length("text")
    return chosen.withColumn("before", before).where(F.col("before") < SAMPLE).select("lang", "h", "text")


def parsers(sample: DataFrame) -> dict[str, Parser]:
    """A parser per language of the sample, by name."""
    def build(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by("h")
        letters = np.concatenate([np.append(Folder.codes(x), np.uint32(BREAK)) for x in t.column("text").to_pylist()])
        return pa.table({"lang": [key[0].as_py()], "parser": pa.array([pickle.dumps(Parser(letters[:SAMPLE]))], pa.binary())})

    rows = sample.groupBy("lang").applyInArrow(build, "lang string, parser binary")
    return {r.lang: pickle.loads(r.parser) for r in sorted(rows.collect())}


def entropies(texts: list[str], models: list[Parser]) -> np.ndarray:
    """Bits per letter of each text under each model; all zero for a text without a letter."""
    total, sizes = np.zeros((len(texts), len(models))), np.ones(len(texts))
    held: list[tuple[int, np.ndarray]] = []

    def parse() -> None:
        held.sort(key=lambda b: -len(b[1]))
        lengths = np.array([len(b) for _, b in held])
        owner = [i for i, _ in held]
        grid = np.full((len(held), lengths[0]), BREAK, np.uint32)
        for row, (_, b) in zip(grid, held):
            row[:len(b)] = b
        for k, m in enumerate(models):
            columns = np.ascontiguousarray(m.coded(grid).T)
            total[:, k] += np.bincount(owner, m.phrases(columns, lengths), len(texts)) * m.bits
        held.clear()

    for i, text in enumerate(texts):
        letters, any_letter = Folder.read(text)
        if any_letter:
            sizes[i] = len(letters)
            for at in range(0, len(letters), BLOCK):
                held.append((i, letters[at:at + BLOCK]))
                if len(held) == AT_ONCE:
                    parse()
    if held:
        parse()
    return total / sizes[:, None]


def parsed(texts: DataFrame, models: Broadcast[dict[str, Parser]]) -> DataFrame:
    """``texts`` with bits instead of the text, those a letter of the best of
    the models, lang, its name, and total, the sum of which the score is the
    inverse; null for a text without a letter."""
    kept = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(models.value)
        for b in batches:
            bits = entropies([t or "" for t in b.column("text").to_pylist()], list(models.value.values()))
            least: list[tuple] = [(None, None, None)] * len(bits)
            for i in np.flatnonzero(bits.any(axis=1)):
                k = int(bits[i].argmin())
                least[i] = float(bits[i, k]), names[k], float(np.exp2((bits[i, k] - bits[i]) * SPAN).sum())
            columns = list(zip(*least)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(columns[0], pa.float64()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.float64())], [*kept, "bits", "lang", "total"])

    schema = T.StructType([*(texts.schema[c] for c in kept), T.StructField("bits", T.DoubleType()),
                           T.StructField("lang", T.StringType()), T.StructField("total", T.DoubleType())])
    return texts.mapInArrow(run, schema)


def merged(passes: list[DataFrame], rid: str) -> DataFrame:
    """The rows of all passes over different languages as one a row number."""
    rows = functools.reduce(DataFrame.union, passes)
    best = F.min(F.when(F.col("bits").isNotNull(), F.struct("bits", "lang"))).alias("best")
    rows = rows.groupBy(rid).agg(F.first("id").alias("id"), best, F.collect_list(F.struct("bits", "total")).alias("parts"))
    total = F.aggregate("parts", F.lit(0.0), lambda n, p: n + p["total"] * F.pow(F.lit(2.0), (F.col("best.bits") - p["bits"]) * SPAN))
    return rows.select("id", F.col("best.lang").alias("lang"), total.alias("total"))


def predicted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              limit: int | None = MAX_LANGUAGES) -> DataFrame:
    """(id, held_out, lang_pred, score) per row. More distinct languages than
    ``limit`` are an error; with None there may be any number."""
    if limit is not None and docs.select(lang_col).distinct().limit(limit + 2).count() > limit + 1:  # one of them may be null
        raise ValueError(f"more than {limit} languages")
    sc = docs.sparkSession.sparkContext
    sample = stage(samples(docs, id_col, text_col, lang_col), "language-samples")
    names = sorted(r.lang for r in sample.select("lang").distinct().collect())
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if len(names) <= MAX_LANGUAGES:
        rows = parsed(texts, sc.broadcast(parsers(sample)))
    else:
        texts, rid = numbered(texts, "language-texts")
        passes = []
        for at in range(0, len(names), MAX_LANGUAGES):
            models = sc.broadcast(parsers(sample.where(F.col("lang").isin(names[at:at + MAX_LANGUAGES]))))
            passes.append(stage(parsed(texts, models), "language-pass"))
            models.destroy()
        rows = merged(passes, rid)
    return rows.select(F.col("id").alias(id_col), F.coalesce(fold("id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.coalesce("lang", F.lit(UNKNOWN)).alias("lang_pred"),
                       F.coalesce(1 / F.col("total"), F.lit(0.0)).alias("score"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), limit=None)


QUERIES = {"op9_language_id": op9_language_id}
ORACLE: dict[str, str] = {}
