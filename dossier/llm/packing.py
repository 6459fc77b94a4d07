"""Best-fit packing by the sum of squares (operator 2).

Documents become token ids, then pieces of at most ``capacity`` tokens, then
sequences. Each shard of pieces is packed by the sum-of-squares rule: with
N(g) open sequences of residual gap g, a piece goes where the sum of N(g)^2
over all gaps becomes smallest (ties: the tightest fit); a full sequence is no
longer open. Shards are dealt by hash, so a source or length with a third of
all rows is spread evenly. Sequences that a round leaves with a wide gap are
taken apart and their pieces packed again in fewer shards, until one shard
holds the rest or the rest no longer halves; so the waste is that of a few
shards, whatever the size of the input, and no task ever sees more than
``per_shard`` pieces (about, as hashing deals them).

Inputs and their results: a null text counts as empty; an empty text is the
end id alone, one piece of length 1; a very long text is encoded whole and cut
into full pieces and a rest; ties and repeated rows are placed one by one; a
null id is kept; an empty table gives an empty one; other columns are neither
read nor returned.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from dossier.llm.base import stage, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
CAPACITY = 4096
#: Pieces per shard, and the widest gap of a sequence that is not reopened.
PER_SHARD, CLOSED = 20_000, 32
#: Entries of each cache of a Python worker (about 100 MB) before it starts anew.
CACHE = 400_000

#: The word pattern of the tokenizer file, for words without
#: characters beyond Latin, where it and Python agree.
RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PLAIN = regex.compile(r"[!-~¡-¬®-ɏ]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others 256 onwards in their order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class Encoder:
    """Text to the tokenizer's ids as little-endian 32-bit bytes.

    White space always ends a token, so a text's ids are those of its words,
    here parted at ASCII white space (other kinds stay within a word).
    Words are looked up in a bounded cache. New ones are cut into runs, which
    the file's own model encodes; a word that is not plain Latin, or may hold
    a special token, goes to the tokenizer as it is."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.symbols = byte_symbols()
        self.words: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _run(self, run: str) -> bytes:
        name = run if run.isascii() else "".join([self.symbols[b] for b in run.encode()])
        return np.array([t.id for t in self.model.tokenize(name)], "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if "<|" in word or not PLAIN.fullmatch(word):
            return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        out = []
        for run in RUNS.findall(word.lower()):
            ids = self.runs.get(run)
            if ids is None:
                ids = self.runs[run] = self._run(run)
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if len(self.words) > CACHE:
            self.words.clear()
        if len(self.runs) > CACHE:
            self.runs.clear()
        known, out = self.words, []
        for word in text.encode().split():
            ids = known.get(word)
            if ids is None:
                ids = known[word] = self._word(word.decode())
            out.append(ids)
        return b"".join(out)


@functools.cache
def encoder(path: str) -> Encoder:
    """One per Python worker, so that its caches serve all its tasks."""
    return Encoder(path)


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str = TOKENIZER, capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32) per piece, and its ids (bytes) on demand."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            at, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(b.column(text_col).to_pylist()):
                ids = enc.encode(text or "") + end
                for k, s in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[s:s + 4 * capacity]
                    at.append(i)
                    piece.append(k)
                    start.append(s // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    kept.append(part)
            out = [b.column(id_col).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                   pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(out + [pa.array(kept, pa.binary())] * with_ids, schema.fieldNames())

    schema = T.StructType([docs.schema[id_col], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())]
                          + [T.StructField("ids", T.BinaryType())] * with_ids)
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per piece, in the order given: its bin, its offset there, and the gap
    that the bin has in the end."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = np.zeros(capacity + 1, np.int64)
    gap: list[int] = []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        gaps = np.flatnonzero(n[size:]) + size
        chosen = -1
        if len(gaps):
            # the change of the sum: one open bin less at the old gap, one more at the new
            change = 2 * (n[gaps - size] - n[gaps] + 1)
            if gaps[0] == size:  # that bin becomes full and is open no more
                change[0] = 1 - 2 * n[size]
            best = int(np.argmin(change))
            if change[best] <= (2 * n[capacity - size] + 1 if size < capacity else 0):
                chosen = int(gaps[best])
        if chosen < 0:
            b, left = len(gap), capacity
            gap.append(left)
        else:
            b, left = open_bins[chosen].pop(), chosen
            n[left] -= 1
        bins[i], offsets[i] = b, capacity - left
        left -= size
        gap[b] = left
        if left:
            open_bins[left].append(b)
            n[left] += 1
    return bins, offsets, np.array(gap, np.int64)[bins] if gap else bins


def place(cut: DataFrame, capacity: int = CAPACITY, per_shard: int = PER_SHARD, closed: int = CLOSED) -> DataFrame:
    """``cut`` (staged pieces with a ``length``) with sequence_id and offset."""
    names = cut.columns
    full = cut.where(F.col("length") == capacity)
    done = [full.withColumn("sequence_id", F.monotonically_increasing_id() + F.lit(1 << 62))
                .withColumn("offset", F.lit(0).cast("long"))]
    rest, turn, before = cut.where(F.col("length") < capacity), 0, None
    while True:
        count = rest.count()
        shards = max(1, -(-count // per_shard))
        last = shards == 1 or before is not None and 2 * count > before
        placed = _round(rest, names, turn, shards, capacity)
        if last:
            done.append(placed)
            break
        placed = stage(placed, "packed")
        done.append(placed.where(F.col("gap") <= closed))
        rest, turn, before = placed.where(F.col("gap") > closed).select(*names), turn + 1, count
    out = done[0].select(*names, "sequence_id", "offset")
    for df in done[1:]:
        out = out.unionByName(df.select(*names, "sequence_id", "offset"))
    return out


def _round(rest: DataFrame, names: list[str], turn: int, shards: int, capacity: int) -> DataFrame:
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), ("row", "ascending")])
        bins, offsets, gaps = sum_of_squares(t.column("length").to_numpy(), capacity)
        base = (turn << 56) + (key[0].as_py() << 24)
        return (t.drop_columns(["row", "shard"]).append_column("sequence_id", pa.array(bins + base))
                .append_column("offset", pa.array(offsets)).append_column("gap", pa.array(gaps)))

    rows = rest.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "shard", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(shards)))
    schema = T.StructType([*(rest.schema[c] for c in names), *(T.StructField(c, T.LongType()) for c in
                                                               ("sequence_id", "offset", "gap"))])
    return rows.groupBy("shard").applyInArrow(run, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of every row of ``docs``: (id, piece, start, length,
    ids_crc32, sequence_id, offset), and ids on demand. ``id_col`` may have
    any name but those."""
    own = "packed_id"
    cut = stage(pieces(docs.select(F.col(id_col).alias(own), F.col(text_col).alias("text")), own, "text", tokenizer,
                       capacity, with_ids), "pieces")
    return place(cut, capacity).withColumnRenamed(own, id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences of ``pack(..., with_ids=True)``: (sequence_id,
    ids as little-endian bytes). A group holds one sequence's tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op2_best_fit_packing": op2_best_fit_packing}
ORACLE: dict[str, str] = {}
