"""Repair of conversation structure by Wagner-Fischer alignment (operator 13).

A conversation's turns are aligned with target strings of role initials: none,
or an optional ``s`` and then ``ua`` any number of times. Keeping a turn is free,
giving it another role costs 3, deleting it 4 (blank and duplicate turns must
go), inserting an empty turn 3; a truncated turn that stays adds 3. The cheapest
edits over all feasible target lengths win; among equals the audit (the edits'
initials in order) that sorts first.

Targets of one kind differ only in how many letters stand before the same end,
so one matrix, filled from the end, holds the costs for all lengths:
``R[i][k]`` aligns the turns from i on with the last k letters. A plain repair
gives the incumbent cost; Ukkonen's band keeps only cells whose distance from
the diagonal can still be paid by it. Each tied target is then traced from the
front, D before I before K before R, and the audits are compared. Conversations
of the same roles and faults share one alignment (a bounded cache).

Turns are dealt by conversation, sorted and streamed; a task holds one
conversation of at most ``LONG`` turns at a time. Longer ones are cut into runs
of ``RUN`` turns at exact positions; each run is aligned alone, from each state a
target can be in to each other; a path through the runs' costs (a few numbers a
run) chooses one alignment for each; the runs' repaired texts are then hashed in
order, as SHA-256 asks for, one run in memory. Both ways give the same rows.

Inputs and their results: null conversations, turns, roles and texts read as one
blank, null turns come first and a null conversation is one of its own; turns of
equal number stand in the order of role and text; a role whose initial is none
of s, u, a can't be kept; empty and very long texts count whole; repeated rows
are duplicates; a conversation without turns after damage has zeros, an empty
audit and the hash of nothing; an empty table gives an empty one; other columns
are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.base import CRC_SQL, count_over, crc32_sql, stage, table
from dossier.operators.ranking import ordered_index

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns of a conversation that one task takes whole, and of a run of a longer one.
LONG, RUN = 2_000, 256
#: Long conversations whose keys may be broadcast.
BROADCAST_KEYS = 100_000
CACHE = 200_000
INF = 1 << 60
#: What a target has so far: nothing, only the ``s``, a user last, an assistant last.
STATES = "0sua"
ROLES = {"u": "user", "a": "assistant"}
#: What ends a target from each state: cost and edits.
ENDS = {"0": (0, ""), "s": (2 * INSERT, "II"), "u": (INSERT, "I"), "a": (0, "")}


def next_role(state: str) -> str:
    return "a" if state == "u" else "u"


# A turn's sign: x if it must be deleted, else s, u, a or o (any other role), in
# upper case if the turn is truncated. A conversation is the string of its signs.

def incumbent(signs: str, state: str) -> int:
    """The cost of a plain repair: delete what must go, give every other turn
    the role that is due."""
    cost = 0
    for sign in signs:
        if sign == "x":
            cost += DELETE
            continue
        role = sign.lower()
        cost += TRUNCATED * sign.isupper()
        if state == "0" and role == "s":
            state = "s"
        else:
            due = next_role(state)
            cost += REROLE * (role != due)
            state = due
    return cost + ENDS[state][0]


class Matrix:
    """Costs of the turns from i on against the last k letters of a target that
    ends with ``last``, within the band of ``bound``; no insertion stands at
    the very end."""

    def __init__(self, signs: str, last: str, bound: int):
        self.signs, self.last, self.other = signs, last, "a" if last == "u" else "u"
        m = len(signs)
        self.rows: list[tuple[int, list[int]]] = [(0, [0])] * (m + 1)
        for i in range(m - 1, -1, -1):
            sign, left = signs[i], m - i
            role, extra = sign.lower(), TRUNCATED * sign.isupper()
            after, below = self.rows[i + 1]
            n, out, before = len(below), [], INF
            low = max(0, left - bound // DELETE)
            for k in range(low, left + bound // INSERT + 1):
                j = k - after
                cost = below[j] + DELETE if 0 <= j < n else INF
                if before + INSERT < cost:
                    cost = before + INSERT
                if sign != "x" and 1 <= j <= n:
                    stay = below[j - 1] + extra + (0 if role == self.letter(k) else REROLE)
                    if stay < cost:
                        cost = stay
                out.append(cost)
                before = cost
            self.rows[i] = (low, out)

    def letter(self, k: int) -> str:
        return self.last if k & 1 else self.other

    def get(self, i: int, k: int) -> int:
        low, costs = self.rows[i]
        return costs[k - low] if 0 <= k - low < len(costs) else INF

    def starts(self, i: int, due: str) -> tuple[int, list[int]]:
        """The best cost from turn i on, over targets that begin with ``due``,
        and their lengths."""
        low, costs = self.rows[i]
        mine = [(c, low + d) for d, c in enumerate(costs) if low + d > 0 and self.letter(low + d) == due and c < INF]
        best = min(mine, default=(INF, 0))[0]
        return best, [k for c, k in mine if c == best]

    def audit(self, i: int, k: int) -> str:
        """The first of the cheapest edits, in the order of their initials."""
        out, m = [], len(self.signs)
        while i < m or k:
            cost = self.get(i, k)
            if i < m and self.get(i + 1, k) + DELETE == cost:
                out.append("D")
                i += 1
            elif k and self.get(i, k - 1) + INSERT == cost:
                out.append("I")
                k -= 1
            else:
                sign = self.signs[i]
                kept = self.get(i + 1, k - 1) + TRUNCATED * sign.isupper() == cost and sign.lower() == self.letter(k)
                out.append("K" if kept else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def edges(signs: str, state: str, bound: int) -> dict[str, tuple[int, str]]:
    """The cheapest (cost, audit) from ``state`` to every state it can lead to;
    costs over ``bound`` may be left out or be too high."""
    m = len(signs)
    found = {state: (DELETE * m, "D" * m)}
    if state == "0":
        kept = [(DELETE * (m - 1) + TRUNCATED * s.isupper(), "D" * i + "K" + "D" * (m - 1 - i))
                for i, s in enumerate(signs) if s in "sS"]
        if kept:
            found["s"] = min(kept)
    for last in "ua":
        matrix = Matrix(signs, last, bound)
        cost, lengths = matrix.starts(0, next_role(state))
        options = [(cost, matrix.audit(0, k)) for k in lengths]
        if state == "0":
            # before the s, turns can only go
            firsts = [(DELETE * i + TRUNCATED * s.isupper() + matrix.starts(i + 1, "u")[0], i)
                      for i, s in enumerate(signs) if s in "sS"]
            best = min(firsts, default=(INF, 0))[0]
            options += [(best, "D" * i + "K" + matrix.audit(i + 1, k)) for c, i in firsts if c == best < INF
                        for k in matrix.starts(i + 1, "u")[1]]
        if last == state:
            options.append(found[state])
        options = [o for o in options if o[0] < INF]
        if options:
            found[last] = min(options)
    return found


@functools.lru_cache(CACHE)
def align(signs: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    bound = min(incumbent(signs, "0"), DELETE * len(signs))
    found = edges(signs, "0", bound)
    return min((cost + ENDS[s][0], audit + ENDS[s][1]) for s, (cost, audit) in found.items())


def repaired(roles: list[str], texts: list[str], audit: str, state: str = "0") -> list[str]:
    """The lines ``role:text`` that an audit leaves, from a state on."""
    out, i = [], 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K":
            state = roles[i][0]
            out.append(f"{roles[i]}:{texts[i]}")
        else:
            state = next_role(state)
            out.append(f"{ROLES[state]}:{texts[i] if edit == 'R' else ''}")
        i += edit != "I"
    return out


def sign_of(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "x"
    sign = role[0] if role[:1] in ("s", "u", "a") else "o"
    return sign.upper() if fault == "truncated" else sign


def text_or_blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone) after damage by crc32 of ``conv:turn``; a
    dropped row stays as ``gone``, so that its conversation is known."""
    hit = F.crc32(F.concat(text_or_blank(F.col(conv)), F.lit(":"), text_or_blank(F.col(turn)))) % 20
    said = text_or_blank(F.col(text))
    said = F.when(hit == 1, "").when(hit == 2, F.translate(said, ".!?", "")).otherwise(said)
    return turns.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.when(hit == 4, "user").otherwise(text_or_blank(F.col(role))).alias("role"), said.alias("text"),
        (hit == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(hit == 3, 2).otherwise(1))).alias("copy")
    ).drop("copy")


def own_fault() -> Column:
    """A turn's fault but for being a duplicate."""
    return (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
            .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise(""))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PAIRS = {"su", "ua", "au"}


class Conversation:
    """The turns of one conversation as they stream by."""

    def __init__(self, conv: object):
        self.conv = conv
        self.turns: list[int] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.faults: list[str] = []

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None:
            self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)

    def row(self, with_text: bool) -> tuple:
        seen: set[tuple[str, str]] = set()
        for i, pair in enumerate(zip(self.roles, self.texts, strict=True)):
            if self.faults[i] != "blank" and pair in seen:
                self.faults[i] = "duplicate"
            seen.add(pair)
        cost, audit = align("".join(map(sign_of, self.roles, self.faults)))
        text = "\n".join(repaired(self.roles, self.texts, audit))
        first = [r[:1] for r in self.roles]
        gaps = max(self.turns) - min(self.turns) + 1 - len(set(self.turns)) if self.turns else 0
        return (self.conv, gaps, *(self.faults.count(f) for f in ("blank", "duplicate", "truncated")),
                sum(a + b not in PAIRS for a, b in zip(first, first[1:], strict=False)), cost, audit,
                hashlib.sha256(text.encode()).hexdigest(), *([text] if with_text else []))


def out_schema(rows: DataFrame, with_text: bool) -> T.StructType:
    texts = ["audit", "repaired_sha256"] + ["repaired"] * with_text
    return T.StructType([rows.schema["conv"], *(T.StructField(c, T.LongType()) for c in COUNTS),
                         *(T.StructField(c, T.StringType()) for c in texts)])


def whole(rows: DataFrame, with_text: bool) -> DataFrame:
    """The result for conversations that a task may take whole."""
    schema = out_schema(rows, with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        now: Conversation | None = None
        done: list[tuple] = []
        for b in batches:
            types = b.schema.field(0).type
            for conv, turn, role, text, gone, fault in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row(with_text))
                    now = Conversation(conv)
                if not gone:
                    now.add(turn, role, text, fault)
            if len(done) >= 1000:
                yield emit(done, types)
                done = []
        if now is not None:
            yield emit([*done, now.row(with_text)], types)

    def emit(done: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        types = [conv_type] + [pa.int64()] * len(COUNTS) + [pa.string()] * (len(schema) - len(COUNTS) - 1)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)],
                                          schema.fieldNames())

    ordered = rows.select("conv", "turn", "role", "text", "gone", own_fault().alias("fault"))
    ordered = ordered.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(run, schema)


def in_runs(rows: DataFrame, with_text: bool, run: int) -> DataFrame:
    """The same for conversations of any length, run by run."""
    key = F.coalesce(F.concat(F.lit("s"), F.col("conv").cast("string")), F.lit("n"))
    rows = rows.select("*", key.alias("key"), own_fault().alias("fault"), F.col("turn").isNotNull().alias("numbered"),
                       F.coalesce("turn", F.lit(0)).alias("number"), F.monotonically_increasing_id().alias("row"))
    every = rows.groupBy("key").agg(F.first("conv").alias("conv"), (F.max("turn") - F.min("turn") + 1).alias("span"))
    numbers = rows.where("numbered and not gone").groupBy("key", "turn").agg(F.lit(1).alias("one"))
    here = rows.where("not gone").groupBy("key").agg((F.max("turn") - F.min("turn") + 1).alias("span"))
    gaps = here.join(numbers.groupBy("key").agg(F.count(F.lit(1)).alias("numbers")), "key").select(
        "key", (F.col("span") - F.col("numbers")).alias("gaps"))

    placed = ordered_index(rows.where("not gone"), ["numbered", "number", "role", "text", "row"], by=["key"], name="at")
    placed = placed.withColumn("same", F.md5(F.concat("role", F.lit("\0"), "text"))).withColumn(
        "run", F.expr(f"at div {run}"))
    first = placed.groupBy("key", "same").agg(F.min("at").alias("first"))
    placed = stage(placed.join(first, ["key", "same"]).select(
        "key", "run", "at", "role", "text", F.when((F.col("fault") != "blank") & (F.col("at") > F.col("first")), "duplicate")
        .otherwise(F.col("fault")).alias("fault")), "turns")
    initial = F.substring("role", 1, 1)
    sign = F.when(F.col("fault").isin("blank", "duplicate"), "x").otherwise(F.when(
        initial.isin("s", "u", "a"), initial).otherwise("o"))
    sign = F.when(F.col("fault") == "truncated", F.upper(sign)).otherwise(sign)

    def joined(field: str) -> Column:
        return F.array_join(F.transform("turns", lambda t: t[field]), "")
    runs = placed.groupBy("key", "run").agg(
        F.sort_array(F.collect_list(F.struct("at", sign.alias("sign")))).alias("turns"),
        F.min(F.struct("at", initial.alias("i"))).alias("head"), F.max(F.struct("at", initial.alias("i"))).alias("tail"),
        *[F.sum((F.col("fault") == f).cast("long")).alias(f) for f in ("blank", "duplicate", "truncated")])
    runs = stage(runs.select("key", "run", joined("sign").alias("signs"), F.col("head.i").alias("head"),
                             F.col("tail.i").alias("tail"), "blank", "duplicate", "truncated"), "runs")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, at, signs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for state in STATES if at else "0":
                    # two more edits reach any other end: an insertion before the last turn that stays, and its role
                    found = edges(signs, state, incumbent(signs, state) + REROLE + INSERT)
                    order = sorted(audit for _, audit in found.values())
                    out += [(key, at, state, to, cost, order.index(audit), audit) for to, (cost, audit) in found.items()]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=pa.schema(
                [(n, pa.string() if n in ("key", "state", "to", "audit") else pa.int64()) for n in names]))

    names = ["key", "run", "state", "to", "cost", "order", "audit"]
    steps = stage(runs.select("key", "run", "signs").repartition("key", "run").mapInArrow(
        each, "key string, run long, state string, to string, cost long, `order` long, audit string"), "alignments")
    chosen = stage(steps.drop("audit").groupBy("key").applyInArrow(
        cheapest, "key string, run long, state string, to string, cost long, ending string"), "chosen")

    borders = runs.select("key", "run", "tail").join(runs.select("key", (F.col("run") - 1).alias("run"), "head"), ["key", "run"])
    borders = borders.groupBy("key").agg(F.sum((~F.concat("tail", "head").isin(*PAIRS)).cast("long")).alias("between"))
    pairs = placed.select("key", "run", "at", initial.alias("i"))
    nexts = pairs.select("key", "run", (F.col("at") - 1).alias("at"), F.col("i").alias("then"))
    inside = pairs.join(nexts, ["key", "run", "at"]).groupBy("key").agg(
        F.sum((~F.concat("i", "then").isin(*PAIRS)).cast("long")).alias("inside"))
    counts = runs.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    costs = chosen.groupBy("key").agg(F.sum("cost").alias("cost"))

    audits = steps.join(chosen.select("key", "run", "state", "to", "ending"), ["key", "run", "state", "to"])
    lines = placed.groupBy("key", "run").agg(F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    lines = lines.join(audits.select("key", "run", "state", "audit", "ending"), ["key", "run"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for i in range(whole_batch.num_rows):
                r = whole_batch.slice(i, 1).to_pylist()[0]
                roles, said = [t["role"] for t in r["turns"]], [t["text"] for t in r["turns"]]
                audit = r["audit"] + r["ending"]
                left = repaired(roles, said, audit, r["state"])
                yield pa.RecordBatch.from_arrays([pa.array([r["key"]]), pa.array([r["run"]], pa.int64()), pa.array(
                    [audit]), pa.array(["\n".join(left)]), pa.array([len(left)], pa.int64())], ["key", "run", "audit", "part", "n"])

    parts = stage(lines.mapInArrow(texts, "key string, run long, audit string, part string, n long"), "repaired-runs")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, started, audits, digest, kept = None, False, [], hashlib.sha256(), []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array(["".join(audits)], pa.string()), pa.array(
                [digest.hexdigest()], pa.string()), pa.array(["\n".join(kept)], pa.string())],
                ["key", "audit", "repaired_sha256", "repaired"])
        for b in batches:
            for k, audit, part, n in zip(*(b.column(c).to_pylist() for c in ("key", "audit", "part", "n")), strict=True):
                if k != key:
                    if key is not None:
                        yield out()
                    key, started, audits, digest, kept = k, False, [], hashlib.sha256(), []
                audits.append(audit)
                if n:
                    digest.update(("\n" * started + part).encode())
                    started = True
                    if with_text:
                        kept.append(part)
        if key is not None:
            yield out()

    ends = parts.repartition("key").sortWithinPartitions("key", "run").mapInArrow(
        chained, "key string, audit string, repaired_sha256 string, repaired string")
    out = every.select("key", "conv")
    for more in (gaps, counts, borders, inside, costs, ends):
        out = out.join(more, "key", "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "cost")}
    zero["illegal"] = (F.coalesce("between", F.lit(0)) + F.coalesce("inside", F.lit(0))).cast("long").alias("illegal")
    nothing = hashlib.sha256().hexdigest()
    return out.select("conv", *[zero[c] for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
                      *([F.coalesce("repaired", F.lit("")).alias("repaired")] if with_text else []))


def cheapest(t: pa.Table) -> pa.Table:
    """The path through a conversation's runs: costs to the end from the last
    run back, then the audit that sorts first, run by run. Two alignments of a
    run from one state never begin each other, so the order decides."""
    steps: dict[int, dict[str, list[dict]]] = {}
    for r in t.to_pylist():
        steps.setdefault(r["run"], {}).setdefault(r["state"], []).append(r)
    order = sorted(steps)
    rest = [dict.fromkeys(STATES, INF) for _ in order] + [{s: c for s, (c, _) in ENDS.items()}]
    for i in range(len(order) - 1, -1, -1):
        for state, options in steps[order[i]].items():
            rest[i][state] = min(o["cost"] + rest[i + 1][o["to"]] for o in options)
    state, out = "0", []
    for i, run in enumerate(order):
        best = min((o for o in steps[run][state] if o["cost"] + rest[i + 1][o["to"]] == rest[i][state]), key=lambda o: o["order"])
        state = best["to"]
        last = i + 1 == len(order)
        out.append({"key": best["key"], "run": run, "state": best["state"], "to": state,
                    "cost": best["cost"] + (ENDS[state][0] if last else 0), "ending": ENDS[state][1] if last else ""})
    return pa.Table.from_pylist(out, schema=pa.schema([("key", pa.string()), ("run", pa.int64()), ("state", pa.string()),
                                                       ("to", pa.string()), ("cost", pa.int64()), ("ending", pa.string())]))


def repair(rows: DataFrame, long: int = LONG, run: int = RUN, with_text: bool = False) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) per conversation of ``rows`` (conv, turn, role, text,
    gone), and its repaired text on demand."""
    spark = rows.sparkSession
    many = stage(rows.groupBy("conv").count().where(F.col("count") > long).select(F.col("conv").alias("long_conv")), "long")
    if many.isEmpty():
        return whole(rows, with_text)
    keys = many if count_over(spark, many, BROADCAST_KEYS) else F.broadcast(many)
    same = F.col("conv").eqNullSafe(F.col("long_conv"))
    return whole(rows.join(keys, same, "left_anti"), with_text).unionByName(
        in_runs(stage(rows.join(keys, same, "left_semi"), "long-turns"), with_text, run))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


#: The same by states instead of targets: per turn and state the least (cost,
#: audit), over insertions before the turn and what becomes of it.
OP13_SQL = rf"""
WITH RECURSIVE {CRC_SQL},
hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS x FROM conversations, steps),
hurt AS (SELECT conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE role END AS role,
  CASE x WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, range(CASE x WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) r(copy)),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt),
fault AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM num),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, max(i) AS m FROM fault GROUP BY conv_id),
adjacent AS (SELECT conv_id, role[1] || lead(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM num),
illegal AS (SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM adjacent GROUP BY conv_id),
-- insertions: from, to, how many; a turn that stays: from, to
ins(f, g, n) AS (VALUES ('0','0',0),('0','u',1),('0','a',2),('s','s',0),('s','u',1),('s','a',2),
  ('u','u',0),('u','a',1),('a','a',0),('a','u',1)),
stay(g, h) AS (VALUES ('0','u'),('0','s'),('s','u'),('u','a'),('a','u')),
moves AS (SELECT f, g, NULL::VARCHAR AS h, n, 'D' AS edit FROM ins WHERE n = 0 UNION ALL SELECT f, g, h, n, edit
  FROM ins JOIN stay USING (g), (VALUES ('K'), ('R')) e(edit) WHERE edit = 'K' OR h <> 's'),
path AS (SELECT conv_id, 0 AS i, '0' AS state, {{'cost': 0, 'audit': '', 'text': ''}} AS best FROM stats UNION ALL
  SELECT conv_id, i + 1, state, min(step) FROM (
    SELECT p.conv_id, p.i, coalesce(h, g) AS state, {{
      'cost': p.best.cost + 3 * n + CASE edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
              + CASE WHEN edit <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END,
      'audit': p.best.audit || repeat('I', n) || edit,
      'text': p.best.text || CASE WHEN n = 0 THEN '' WHEN n = 2 THEN 'user:' || chr(10) || 'assistant:' || chr(10)
              WHEN f = 'u' THEN 'assistant:' || chr(10) ELSE 'user:' || chr(10) END
              || CASE edit WHEN 'D' THEN '' WHEN 'K' THEN role || ':' || text || chr(10)
                 ELSE CASE h WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text || chr(10) END}} AS step
    FROM path p JOIN fault t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1 JOIN moves ON f = p.state
    WHERE edit = 'D' OR fault NOT IN ('blank', 'duplicate') AND (edit = 'R' OR role[1] = h))
  GROUP BY conv_id, i, state),
fin(state, cost, audit, text) AS (VALUES ('0', 0, '', ''), ('a', 0, '', ''), ('u', 3, 'I', 'assistant:' || chr(10)),
  ('s', 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
least_edits AS (SELECT p.conv_id, min({{'cost': best.cost + cost, 'audit': best.audit || audit, 'text': best.text || text}}) AS best
  FROM path p JOIN fin USING (state) JOIN stats s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.m = p.i GROUP BY p.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(left(best.text, -1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN illegal l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN least_edits e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""

QUERIES = {"op13_conversation_repair": op13_conversation_repair}
ORACLE = {"op13_conversation_repair": OP13_SQL}
