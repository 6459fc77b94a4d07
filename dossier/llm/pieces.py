"""Exact merge-type encoding by backtracking, and decoding (operator 11).

The model is a sentencepiece file of kind BPE with byte fallback. What its
merging gives (best score first, ties from the left) is found without merging
the text. Three facts carry it:

* A sequence of pieces is the merged form of its text exactly if every two
  neighbours are the merged form of theirs: up to the first merge across a
  border, both sides merge as they would alone. ``Model.fits`` decides that for
  two pieces by merging their characters anew, once per pair of a worker.
* So at most one sequence ends at any place of the text, and a place that was
  once found to lead nowhere stays so: a bitfield keeps these places, and a
  text takes time in proportion to its length.
* Where no piece holds two neighbouring characters side by side, no merge can
  cross between them. So a text falls into segments that are encoded one by one
  (``segments``); the borders are read off the file's pieces, and nothing is
  assumed of words.

The pieces that start at each place, longest first, come from an Aho-Corasick
automaton of the reversed pieces over the reversed segment. The longest goes
first; a piece that doesn't fit its predecessor, or ends at a failed place,
gives way to the next shorter one, and if none is left, the place has failed
and the piece before it is taken back. A character that no piece holds stands
for itself and becomes byte pieces.

Rows are encoded where they lie (mapInArrow, no shuffle); a worker keeps the
segments it has met in a bounded cache, and holds one batch at a time
(``ROWS``, a few rows of Arrow memory).

Inputs and their results: a null text counts as empty; an empty text has no
ids and decodes to an empty text; a very long text, also one without blanks,
is encoded whole; the strings of control and byte pieces (``<s>``, ``<0x0A>``)
in a text are plain text; the blank mark itself in a text is read as a blank,
as the library does; ties and repeated rows are encoded one by one; a null id
is kept; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from dossier.llm.base import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: The library's mark for a blank.
BLANK = "▁"
#: Segments and pairs a Python worker keeps before it starts anew, and the
#: longest segment it keeps (about 100 MB in all).
CACHE, KEPT_CHARS = 250_000, 64
ROWS = 500
GROUPS = 12
NONE: dict[str, bool] = {}


def segments(pieces: Iterable[str]) -> re.Pattern[str]:
    """A pattern that cuts a text only where no piece can stand across the cut.

    Characters that stand side by side in some piece belong together; groups of
    such characters (letters of a script, say) never merge with each other. A
    segment is blanks and a run of one group after them; the largest ``GROUPS``
    are told apart, all other characters that merge make one more group, and
    those that never merge the last. If a piece has a blank after another
    character, a text stays whole."""
    group: dict[str, str] = {}

    def top(c: str) -> str:
        while group.setdefault(c, c) != c:
            group[c] = group[group[c]]
            c = group[c]
        return c
    for p in pieces:
        bare = p.lstrip(BLANK)
        if BLANK in bare:
            return re.compile("(?s).+")
        for a, b in zip(bare, bare[1:] or bare * (p != bare), strict=False):
            group[top(a)] = top(b)
    members: dict[str, list[str]] = {}
    for c in group:
        members.setdefault(top(c), []).append(c)
    ranked = sorted(members.values(), key=lambda m: (-len(m), m))
    named = [*ranked[:GROUPS], [c for m in ranked[GROUPS:] for c in m]]
    classes = [re.escape("".join(sorted(m))) for m in named if m]
    return re.compile("|".join([*(f"{BLANK}*[{c}]+" for c in classes), f"{BLANK}+", f"[^{BLANK}{''.join(classes)}]+"]))


class Model:
    """A model file: its pieces, their order of merging and the automaton."""

    def __init__(self, path: str):
        lib = SentencePieceProcessor(model_file=path)
        ids = range(lib.get_piece_size())
        if any(lib.is_unused(i) for i in ids):
            raise ValueError("unused pieces are not supported")
        plain = [i for i in ids if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.piece = {i: lib.id_to_piece(i) for i in plain}
        self.ids = {p: i for i, p in self.piece.items()}
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.byte = {int(lib.id_to_piece(i)[3:5], 16): i for i in ids if lib.is_byte(i)}
        self.value = {i: b for b, i in self.byte.items()}
        #: The dummy blank that the file's normaliser puts before a text.
        self.prefix = BLANK if lib.encode_as_pieces("x")[0].startswith(BLANK) else ""
        if "".join(lib.encode_as_pieces("  x  \ufb01")) != f"{self.prefix}{BLANK * 2}x{BLANK * 2}\ufb01".replace(
                "\ufb01", "".join(f"<0x{b:02X}>" for b in "\ufb01".encode()) if "\ufb01" not in self.ids else "\ufb01"):
            raise ValueError("a file that changes texts before it parts them is not supported")
        self.segment = segments(self.ids)
        # a piece that its own characters don't merge to never occurs
        self.reach = {p for p in self.ids if len(p) == 1 or self.merged(p) == [p]}
        #: Per piece: itself and the pieces it begins with, longest first, to its first character.
        self.choices = {p: [p[:k] for k in range(len(p), 0, -1) if k == 1 or p[:k] in self.reach] for p in self.reach}
        self.trie = ahocorasick.Automaton()
        for p in self.reach:
            self.trie.add_word(p[::-1], self.choices[p])
        self.trie.make_automaton()
        self.bytes_of = [bytes([self.value[i]]) if i in self.value else self.piece.get(i, "").replace(BLANK, " ").encode()
                         for i in ids]
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        #: Segments met, and those met before them: when the first is full, it becomes the second.
        self.segments: dict[str, tuple[str, int, bytes]] = {}
        self.before: dict[str, tuple[str, int, bytes]] = {}

    def merged(self, text: str) -> list[str]:
        """Merging by its definition: the neighbours whose union has the best
        score, the leftmost of equals, until none is a piece. For short texts."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether the two stay as they are when their characters are merged anew."""
        if self.n_pairs > 4 * CACHE:
            self.pairs.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        known = self.merged(left + right) == [left, right]
        self.pairs.setdefault(left, {})[right] = known
        return known

    def cut(self, text: str) -> list[str]:
        """The pieces of ``text``, and single characters where no piece starts."""
        end = len(text)
        # the longest piece that ends at a place of the reversed text comes first of those there
        starting = dict(list(self.trie.iter(text[::-1]))[::-1])
        failed: bytearray | None = None
        found: list[str] = []
        ranks: list[int] = []  # which of the pieces that start there each of ``found`` is
        at = rank = 0
        fitting: dict[str, bool] | None = None  # what is known to fit the last of ``found``
        while at < end:
            choice = starting.get(end - 1 - at) or text[at]
            size = len(choice)
            while rank < size:
                p = choice[rank]
                if failed is None or not failed[at + len(p) >> 3] >> (at + len(p) & 7) & 1:
                    if fitting is None:
                        break
                    fits = fitting.get(p)
                    if self.fits(found[-1], p) if fits is None else fits:
                        break
                rank += 1
            if rank < size:
                found.append(p)
                ranks.append(rank)
                at, rank = at + len(p), 0
            else:
                if failed is None:
                    failed = bytearray(end // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                if not found:
                    raise ValueError("a text that merging cannot have made")
                at, rank = at - len(found.pop()), ranks.pop() + 1
            fitting = self.pairs.get(found[-1], NONE) if found else None
        return found

    def encode(self, segment: str) -> list[int]:
        out: list[int] = []
        for p in self.cut(segment):
            i = self.ids.get(p)
            if i is None:
                out += [self.byte[b] for b in p.encode()]
            else:
                out.append(i)
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The text of ``ids`` in UTF-8, the dummy blank still before it."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The library's ``decode(ids)`` for ids that ``encode`` can give."""
        raw = self.decode_bytes(ids)
        return (raw[1:] if self.prefix and raw.startswith(b" ") else raw).decode("utf-8", "replace")

    def text(self, text: str) -> list[tuple[str, int, bytes]]:
        """Per segment: its ids as decimals with commas between, their number, and
        what they decode to."""
        if not text:
            return []
        if len(self.segments) > CACHE:
            self.segments, self.before = {}, self.segments
        known = self.segments
        found = self.segment.findall(self.prefix + text.replace(" ", BLANK))
        out = list(map(known.get, found))
        if None in out:
            for at, got in enumerate(out):
                if got is None:
                    segment = found[at]
                    out[at] = known.get(segment) or self.met(segment)
        return out

    def met(self, segment: str) -> tuple[str, int, bytes]:
        got = self.before.get(segment)
        if got is None:
            ids = self.encode(segment)
            got = ",".join(map(str, ids)), len(ids), self.decode_bytes(ids)
        if len(segment) <= KEPT_CHARS:
            self.segments[segment] = got
        return got

    def ids_of(self, text: str) -> list[int]:
        return [int(i) for part, _, _ in self.text(text) for i in part.split(",")]


@functools.cache
def model(path: str) -> Model:
    """One per Python worker, so that its caches serve all its tasks."""
    return Model(path)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL) -> DataFrame:
    """(id_col, ids array, decoded) per row of ``docs``; ``id_col`` keeps its name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                ids = [m.ids_of(t or "") for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(
                    [m.decode(i) for i in ids], pa.string())], schema.fieldNames())

    own = docs.select(docs[id_col].alias("encoded_id"), docs[text_col].alias("text"))
    schema = T.StructType([own.schema["encoded_id"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])
    return own.mapInArrow(run, schema).withColumnRenamed("encoded_id", id_col)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``: what
    ``encoded`` gives, hashed segment by segment without lists of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            n, ids_hash, text_hash = [], [], []
            for text in b.column(1).to_pylist():
                parts = m.text(text or "")
                raw = b"".join([p[2] for p in parts])
                n.append(sum([p[1] for p in parts]))
                ids_hash.append(hashlib.sha256(",".join([p[0] for p in parts]).encode()).hexdigest())
                if m.prefix and raw.startswith(b" "):
                    raw = raw[1:]
                text_hash.append(hashlib.sha256(raw.decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(
                text_hash)], schema.fieldNames())

    own = docs.select(docs[id_col].alias("encoded_id"), docs[text_col].alias("text"))
    schema = T.StructType([own.schema["encoded_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return own.mapInArrow(run, schema).withColumnRenamed("encoded_id", id_col)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op11_sentencepiece": op11_sentencepiece}
ORACLE: dict[str, str] = {}
