"""Quality rules by an isolation forest on rule statistics (operator 5).

Each whole text becomes a few counts, and those the shares that rules look at
(word length, symbols, capitals, letters, marks). A document that fails
a base rule is rejected outright. Of the rest, the forest judges: trees split
the space of the shares at random, and a document that random splits part from
the others after a short path is anomalous: score 2^(-mean path / normal path).

The forest is fitted on a bounded sample of labelled rows of good quality
(about ``POOL`` rows, drawn by a hash; each of ``TREES`` trees draws ``DRAWN``
of them). Its threshold comes from all labelled rows that
pass the base rules: their scores are counted in ``BINS`` steps on Spark, and
the step that parts good from bad best (share of the good kept plus share of
the bad rejected; ties: the one that keeps more) is taken. Counts and scores
cover every document; nothing is shuffled but labelled rows and the bins, and
the driver holds the sample, the forest and the bins, all of fixed size.

Inputs and their results: a null or empty text, or one without a word, has all
counts zero and fails the base rules; very long texts are counted whole;
repeated rows are judged alike; a null id has no label; a document with
several labels counts once for each; without labelled rows of both kinds that
pass the base rules, all that pass are kept; an empty table gives an empty
one; other columns are not read, and ``filtered`` returns them as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.base import SPACES, fresh, stage, table

TREES, DRAWN, POOL, BINS = 100, 256, 20_000, 1000
MIN_WORDS, MAX_REPEATED = 50, 50

#: The symbols that the rules count.
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_letters", "n_upper", "n_marks"]
#: Kinds of characters, as numbers of a table by code point; those past its end are letters.
SPACE, SYMBOL, UPPER, LETTER, MARK, OTHER = range(6)
TABLE_END = 0x3000
#: Distinct words beyond which three of their numbers don't fit 64 bits.
REDUCE = 1 << 20


def kinds() -> np.ndarray:
    out = np.full(TABLE_END + 1, LETTER, np.uint8)
    for c in range(TABLE_END):
        ch, cat = chr(c), unicodedata.category(chr(c))
        out[c] = (SPACE if ch in SPACES else SYMBOL if ch in SYMBOLS else UPPER if cat in ("Lu", "Lt")
                  else LETTER if cat[0] in "LM" else MARK if cat[0] in "PS" else OTHER)
    return out


KINDS = kinds()


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    pairs = ids[:-2] * len(known) + ids[1:-1]
    if len(known) > REDUCE:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, n = np.unique(pairs * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = n[at] > 1
    held = np.zeros(len(words), bool)
    for k in range(3):
        held[k:len(words) - 2 + k] |= twice
    return int(held.sum())


def counts(text: str) -> list[int]:
    """The numbers of ``COUNTS`` for a text."""
    words = text.encode().split()
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    n = np.bincount(KINDS[np.minimum(codes, TABLE_END)], minlength=6)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return [len(words), len(text) - int(n[SPACE]), int(n[SYMBOL]), len(lines) - len(set(lines)), repeated_words(words),
            int(n[UPPER] + n[LETTER]), int(n[UPPER]), int(n[MARK])]


def statistics(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and COUNTS (long) per row, in one pass over the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([counts(t or "") for t in b.column(text_col).to_pylist()], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *map(pa.array, rows.T)], [*keep, *COUNTS])

    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(run, schema)


def base_failed(of: dict[str, Column] | None = None) -> Column:
    """Whether the base rules reject; ``of`` has the counts' columns where they aren't top-level."""
    of = of or {c: F.col(c) for c in COUNTS}
    return (of["n_words"] < MIN_WORDS) | (100 * of["n_repeat_words"] > MAX_REPEATED * of["n_words"])


def shares(of: dict[str, Column] | None = None) -> list[Column]:
    """What the forest splits on. Length and repetition are left to the base
    rules: among short clean texts they scatter as widely as in bad ones."""
    of = of or {c: F.col(c) for c in COUNTS}

    def share(a: str, b: str) -> Column:
        return F.coalesce(of[a] / F.when(of[b] > 0, of[b]), F.lit(0.0))
    return [share("word_chars", "n_words"), share("n_symbols", "word_chars"), share("n_upper", "n_letters"),
            share("n_letters", "word_chars"), share("n_marks", "word_chars")]


class Forest:
    """Trees as arrays: node i splits feature f[i] at cut[i] into the nodes
    2i + 1 and 2i + 2; a leaf (f = -1) holds its path length."""

    def __init__(self, sample: np.ndarray, trees: int, drawn: int, seed: int = 0):
        self.size = min(drawn, len(sample))
        self.depth = max(1, int(np.ceil(np.log2(max(2, self.size)))))
        self.f = np.full((trees, 2 ** (self.depth + 1)), -1, np.int64)
        self.v = np.zeros(self.f.shape)
        for t in range(trees):
            rng = np.random.default_rng([seed, t])
            self._grow(t, 0, 0, sample[rng.choice(len(sample), self.size, replace=False)], rng)

    def _grow(self, t: int, node: int, depth: int, x: np.ndarray, rng: np.random.Generator) -> None:
        low, high = x.min(axis=0), x.max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth == self.depth or not len(varied):
            self.v[t, node] = depth + normal_path(len(x))
            return
        f = rng.choice(varied)
        cut = rng.uniform(low[f], high[f])
        left = x[:, f] <= cut
        self.f[t, node], self.v[t, node] = f, cut
        for child, part in ((2 * node + 1, x[left]), (2 * node + 2, x[~left])):
            if len(part):
                self._grow(t, child, depth + 1, part, rng)
            else:
                self.v[t, child] = depth + 1

    def score(self, x: np.ndarray) -> np.ndarray:
        """Per row: near 1 for anomalies, 0.5 for the usual path."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, v in zip(self.f, self.v):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                inner = f[node] >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f[node], 0)] > v[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += v[node]
        return 2.0 ** (-total / len(self.f) / max(normal_path(self.size), 1e-9))


def normal_path(n: int) -> float:
    """The mean path of an unsuccessful search in a binary tree of n points."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def scored(stats: DataFrame, forest: Forest | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``stats`` and its anomaly ``score`` (0 without a forest)."""
    columns = [c.alias(f"x{i}") for i, c in enumerate(shares())]
    inputs = [f"x{i}" for i in range(len(columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(c).to_numpy() for c in inputs], axis=1)
            score = forest.score(x) if forest else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(score)], [*keep, "score"])

    schema = T.StructType([*(stats.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    return stats.select(*keep, *columns).mapInArrow(run, schema)


def fitted(stats: DataFrame, labels: DataFrame) -> tuple[Forest | None, float]:
    """Forest and threshold from ``stats`` (staged, with id) and ``labels``
    (id, good); a score above the threshold is an anomaly."""
    known = stage(stats.where(~base_failed()).join(labels.where("id is not null and good is not null"), "id"), "labelled")
    good = known.where("good").select(*[c.alias(f"x{i}") for i, c in enumerate(shares())])
    share = min(1.0, POOL / max(1, good.count()))
    drawn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < F.lit(share * (1 << 30))
    sample = good.where(drawn).toArrow()
    pool = np.stack([c.to_numpy() for c in sample.columns], axis=1)
    if not len(pool):
        return None, 1.0
    forest = Forest(pool, TREES, DRAWN)
    step = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("step")
    rows = scored(known, forest, ["good"]).groupBy(step).agg(
        F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(~F.col("good"), 1)).alias("bad")).collect()
    n_good, n_bad = np.zeros(BINS), np.zeros(BINS)
    for r in rows:
        n_good[r.step], n_bad[r.step] = r.good, r.bad
    if not n_bad.sum():
        return forest, 1.0
    parted = np.cumsum(n_good) / n_good.sum() + 1 - np.cumsum(n_bad) / n_bad.sum()
    last = BINS - 1 - int(np.argmax(parted[::-1]))
    return forest, (last + 1) / BINS


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           good: str = "quality = 1", keep: list[str] | None = None) -> DataFrame:
    """Per row the columns ``keep`` (by default the id), COUNTS, base_failed, score and kept."""
    keep = keep or [id_col]
    plain = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(id_col).alias("id"),
                        F.col(text_col).alias("text"))
    own = ["id", *[f"k{i}" for i in range(len(keep))]]
    stats = stage(statistics(plain, "text", own), "rule-statistics")
    forest, threshold = fitted(stats, labels.select(F.col(id_col).alias("id"), F.expr(good).alias("good")))
    out = scored(stats.withColumn("base_failed", base_failed()), forest, [*own, *COUNTS, "base_failed"])
    kept = ~F.col("base_failed") & (F.floor(F.col("score") * BINS) < round(threshold * BINS))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *COUNTS, "base_failed", "score",
                      kept.alias("kept"))


def filtered(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             good: str = "quality = 1") -> DataFrame:
    """The rows of ``docs`` that are kept. Counts and scores are columns beside
    the row (Python sees only what it needs of it), so nothing is joined and no
    text is shuffled; the rows are staged once with their counts, so that texts
    are read once."""
    inside = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

    @F.pandas_udf(inside)
    def counted(text: pd.Series) -> pd.DataFrame:
        rows = [counts(t or "") for t in text]
        return pd.DataFrame(np.array(rows, np.int64).reshape(-1, len(COUNTS)), columns=COUNTS)

    own = fresh(docs, "counts")
    rows = stage(docs.withColumn(own, counted(F.col(text_col))), "rule-docs")
    stats = rows.select(F.col(id_col).alias("id"), f"{own}.*")
    forest, threshold = fitted(stats, labels.select(F.col(id_col).alias("id"), F.expr(good).alias("good")))

    @F.pandas_udf(T.DoubleType())
    def anomaly(x: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.score(x.to_numpy(float)) if forest else np.zeros(len(x)))

    given = {c: F.col(own)[c] for c in COUNTS}
    score = anomaly(F.struct(*[c.alias(f"x{i}") for i, c in enumerate(shares(given))]))
    kept = ~base_failed(given) & (F.floor(score * BINS) < round(threshold * BINS))
    return rows.where(kept).select(*docs.columns)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS[:5], "base_failed", "kept", "score")


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLE: dict[str, str] = {}
