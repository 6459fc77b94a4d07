"""Op12 against the tree built by hand."""

import hashlib
import random
import zlib

import duckdb
import pytest

from dossier.llm import merkle as K


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def up(nodes):
    """All levels, the nodes first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        here = levels[-1]
        levels.append([h(*here[i:i + 3]) for i in range(0, len(here), 3)])
    return levels


def around(levels, at):
    out = []
    for here in levels[:-1]:
        run = at // 3 * 3
        out.append((here[run:at], here[at + 1:run + 3]))
        at //= 3
    return out


def spec(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = up([leaf(r) for r in groups[s]])
    top = up([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = around(trees[s], i) + around(top, k)
            changed = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and changed is not None:
                changed = changed.replace("\n", "")
            x = leaf((*r[:4], changed))
            for left, right in path:
                x = h(*left, x, *right)
            proof = h(*["".join(left + right) for left, right in path])
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], proof, x, x == top[-1][0]))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, LEAF int, tree string, pos string"


def table(rows):
    return [(*r, 1, "t", "p") for r in rows]


def cases():
    rng = random.Random(8)
    rows = []
    for source, n in ((None, 5), ("a", 1), ("b", 2500), ("é", 3), ("", 10), ("zz", 4)):
        for i in rng.sample(range(-2**40, 2**40) if source == "zz" else range(10 * n), n):
            rows.append((i, source, rng.choice(["en", None]), rng.choice([None, 5]),
                         rng.choice([None, "", "x", "a\nb\n", "long " * 50, "é\n漢"])))
    rows += [(None, "a", None, None, None), (None, "a", "en", 1, "x"), (7, "dup", "en", 1, "x\n")]
    rows += [(64, "dup", "en", 1, "x\n")] * 5 + [(64, "dup", "en", 1, "y"), (65, "dup", "en", 1, "y"), (2, "dup", None, 1, "y")]
    rows += [(2**63 - 1, "dup", "en", 1, "x"), (-2**63, "dup", "en", 1, "x\ny")]
    return rows


def query(docs, **more):
    out = K.manifest(docs, **more)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, h(r.proof), r.folded_root, r.verified) for r in out.collect()), key=KEY)


KEY = repr


def test_manifest(spark):
    rows = cases()
    want = spec(rows)
    assert query(spark.createDataFrame(table(rows), SCHEMA)) == sorted(want, key=KEY)
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("per_block", [1, 2])
def test_rounds_of_small_blocks(spark, per_block):
    """Blocks of 3 and 9: several rounds up and down, in the groups' tree too."""
    rng = random.Random(9)
    rows = [(i, f"s{rng.randrange(40):02}" if i % 3 else "hot", "en", i, "x\ny") for i in range(300)]
    assert query(spark.createDataFrame(table(rows), SCHEMA), per_block=per_block) == sorted(spec(rows), key=KEY)


def test_small_and_empty_tables(spark):
    one = [(5, "a", "en", 1, "x\n")]
    assert query(spark.createDataFrame(table(one), SCHEMA)) == spec(one)
    assert query(spark.createDataFrame([], SCHEMA)) == []


def test_sql(spark, sf):
    got = sorted(map(tuple, K.op12_merkle_manifest(spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.execute(K.OP12_SQL).fetchall()) == got
    rows = con.execute("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall()
    assert sorted(spec(rows)) == got


@pytest.mark.parametrize("total", [1, 2, 3, 4, 9, 10, 27, 28, 2187, 2188])
def test_height(total):
    assert K.height(total) == len(up([str(i) for i in range(total)])) - 1
