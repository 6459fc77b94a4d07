"""Op1 against brute force."""

import random

import pytest

from dossier.llm import linededup as L

SCHEMA = "doc_id long, text string, rid int, cuts string, rank int, N int"
SPACES = "\t\n\x0b\x0c\r "


def spec(docs, min_words):
    """Texts of [(id, text)] in row order, by comparing every pair of positions."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    lines = {i: [x.strip(SPACES) for x in docs[i][1].split("\n")] for i in order if docs[i][1] is not None}
    places = [(i, k) for i in order if i in lines for k in range(len(lines[i]))]
    gone = set()
    for b, (j, q) in enumerate(places):
        for i, p in places[:b]:
            n = 0
            while p + n < len(lines[i]) and q + n < len(lines[j]) and lines[i][p + n] == lines[j][q + n]:
                n += 1
            if n and sum(len(x.split()) for x in lines[j][q:q + n]) >= min_words:
                gone |= {(j, q + k) for k in range(n)}
    return [None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
            for i, (_, t) in enumerate(docs)]


def run(spark, docs, min_words):
    df = spark.createDataFrame([(d, t, i, "", 1, 2) for i, (d, t) in enumerate(docs)], SCHEMA).coalesce(1)
    out = L.dedup_lines(df, min_words=min_words, counts=("lines", "gone"))
    assert out.columns == [*df.columns, "lines", "gone"]
    rows = {r.rid: r for r in out.collect()}
    for i, (_, t) in enumerate(docs):
        assert rows[i].lines == (0 if t is None else t.count("\n") + 1)
    return [rows[i].text for i in range(len(docs))]


@pytest.mark.parametrize("seed,min_words", [(1, 1), (2, 4)])
def test_random_texts(spark, seed, min_words):
    rng = random.Random(seed)
    line = ["a", "b b", "c c c", "", " d\t", "d"]
    docs = [(rng.randrange(9), "\n".join(rng.choice(line) for _ in range(rng.randrange(1, 14)))) for _ in range(12)]
    docs += [(rng.randrange(9), docs[rng.randrange(8)][1]) for _ in range(6)]
    assert run(spark, docs, min_words) == spec(docs, min_words)


def test_edges(spark):
    long = "\n".join(f"line {i} of many words here" for i in range(150))
    docs = [(5, long), (None, "x y z\nq"), (None, "x y z\nr"), (2, None), (3, ""), (3, ""), (4, long), (4, long),
            (6, "same same\n" * 40), (7, "new\n" + long + "\nend"), (8, "x y z"), (9, "one")]
    got = run(spark, docs, 3)
    assert got == spec(docs, 3)
    assert got[6] == long and got[7] == got[0] == "" and got[9] == "new\nend" and got[10] == "x y z"
    assert got[1] == "q" and got[2] == "r" and got[3] is None


def test_nothing_repeats_and_empty(spark):
    assert run(spark, [(1, "a\nb"), (2, "c")], 1) == ["a\nb", "c"]
    assert L.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark, sf):
    p = L.op1_line_dedup(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in p and "Arrow" not in p and "Cartesian" not in p
