"""Op13 against a search over states, and its two ways against each other."""

import functools
import hashlib
import random
import re
import zlib

import duckdb
import pytest

from dossier.llm import conversation as C


def spec_align(signs):
    """The least (cost, audit) by trying every edit, from the last turn back."""
    @functools.cache
    def best(i, state, inserted):
        out = []
        if i == len(signs) and state in "0a":
            out.append((0, ""))
        due = "a" if state == "u" else "u"
        if inserted < 2:
            cost, audit = best(i, due, inserted + 1)
            out.append((cost + 3, "I" + audit))
        if i < len(signs):
            sign, role = signs[i], signs[i].lower()
            extra = 3 if sign.isupper() else 0
            cost, audit = best(i + 1, state, 0)
            out.append((cost + 4, "D" + audit))
            if sign != "x":
                cost, audit = best(i + 1, due, 0)
                out.append((cost + 3 + extra, "R" + audit))
                if role == due:
                    out.append((cost + extra, "K" + audit))
                if role == "s" and state == "0":
                    cost, audit = best(i + 1, "s", 0)
                    out.append((cost + extra, "K" + audit))
        return min(out, default=(10**9, ""))
    return best(0, "0", 0)


def test_align():
    rng = random.Random(1)
    for _ in range(4000):
        signs = "".join(rng.choices("sSuUuaAaxoO", k=rng.randrange(0, 14)))
        assert C.align(signs) == spec_align(signs), signs
    for signs in ("", "x", "s", "S", "o", "uaua", "suaua", "auau", "us", "ss", "u" * 40, "au" * 30):
        assert C.align(signs) == spec_align(signs), signs


def spec(rows):
    """The contract, conversation by conversation; rows are (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        mine = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        mine += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        faults, seen = [], set()
        for _, role, text in turns:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                          "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        signs = "".join("x" if f in ("blank", "duplicate") else (r[0] if r and r[0] in "sua" else "o").upper()
                        if f == "truncated" else (r[0] if r and r[0] in "sua" else "o")
                        for (_, r, _), f in zip(turns, faults, strict=True))
        cost, audit = spec_align(signs)
        lines, i, last = [], 0, "0"
        for edit in audit:
            if edit == "D":
                i += 1
                continue
            due = "a" if last == "u" else "u"
            last = turns[i][1][0] if edit == "K" else due
            name = turns[i][1] if edit == "K" else {"u": "user", "a": "assistant"}[due]
            lines.append(f"{name}:{'' if edit == 'I' else turns[i][2]}")
            i += edit != "I"
        numbers = [t[0] for t in turns if t[0] is not None]
        heads = [t[1][:1] for t in turns]
        out.append((conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                    faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:], strict=False)), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def cases():
    rng = random.Random(2)
    rows = []
    for conv in [None, *range(60)]:
        for turn in rng.sample(range(30), rng.randrange(1, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(
                ["user", "assistant", "user", "assistant", "system", "", None, "tool", "User"]),
                rng.choice(["Yes.", "No!", "half", "", None, " \n", "ends. \t\n", "é漢", "a. ", "x" * 500 + "?"])))
    rows += [(60, 1, "user", "Again.")] * 3 + [(61, 0, "system", "Only.")]
    rows += [(62, i, "user" if i % 2 == 0 else "assistant", f"Line {i}.") for i in range(150)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, KEY int, cost string, gone int"
KEY = repr


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 0) for r in rows], SCHEMA)


@pytest.mark.parametrize("limits", [{}, {"long": 4, "run": 3}, {"long": 0, "run": 1}])
def test_repair(spark, limits):
    rows = cases()
    got = C.repair(C.damaged(frame(spark, rows)), **limits, with_text=True).collect()
    assert sorted(map(lambda r: tuple(r)[:9], got), key=KEY) == sorted(spec(rows), key=KEY)
    assert all(hashlib.sha256(r.repaired.encode()).hexdigest() == r.repaired_sha256 for r in got)


def test_all_dropped_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hello.")]
    got = C.repair(C.damaged(frame(spark, rows))).collect()
    assert list(map(tuple, got)) == spec(rows) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert list(map(tuple, C.repair(C.damaged(frame(spark, rows)), long=0).collect())) == spec(rows)
    assert C.repair(C.damaged(frame(spark, rows).limit(0))).collect() == []


def test_sql_and_spec(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    got = sorted(map(tuple, C.op13_conversation_repair(spark, sf).collect()))
    assert got == sorted(spec(rows))
    assert sorted(con.execute(C.OP13_SQL).fetchall()) == got


def test_sql_on_odd_rows():
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    rows = [r for r in cases() if r[2] != ""]
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(C.OP13_SQL).fetchall(), key=KEY) == sorted(spec(rows), key=KEY)
