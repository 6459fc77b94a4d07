"""Multi-line CSV by blocks: the same rows as one task, wherever blocks end."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from dossier.sources import csv as C
from dossier.sources.csv_splits import lines

SCHEMA = TY.StructType([TY.StructField("id", TY.LongType()), TY.StructField("text", TY.StringType()),
                        TY.StructField("note", TY.StringType())])


def texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["plain", 'say "hi"', "a, b", "\n", "\n\n", '"', '""', ",", "é漢", " ", "\r\n", "x" * 50, "'"]
    return [None if i % 17 == 0 else "".join(rng.choices(parts, k=rng.randrange(8))) for i in range(n)]


def rows(n, seed=1):
    return [(i, t, None if i % 5 else f"n{i}") for i, t in enumerate(texts(n, seed))]


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def key(r):
    return tuple((v is None, str(v)) for v in r)


def test_one_file_in_many_tasks(spark, tmp_path, small_blocks):
    """Records, quotes and line breaks across blocks, one record over many."""
    want = [*rows(300), (999, "long\n" * 2000 + '"end"', "z")]
    path = str(tmp_path / "one")
    C.write_csv(spark.createDataFrame(want, SCHEMA).coalesce(1), path)
    tasks = lines(spark, [path], "UTF-8").select(F.spark_partition_id()).distinct().count()
    assert tasks > 10
    got = C.read_csv(spark, path, SCHEMA, split=True)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_latin1(spark, tmp_path, small_blocks):
    want = [(i, f"José {i}\nMüller", None) for i in range(40)]
    path = str(tmp_path / "latin")
    C.write_csv(spark.createDataFrame(want, SCHEMA).coalesce(1), path, encoding="ISO-8859-1")
    got = C.read_csv(spark, path, SCHEMA, encoding="ISO-8859-1", split=True)
    assert sorted(map(tuple, got.collect())) == want


def test_shards_of_few_headers_are_one_scan(spark, tmp_path):
    """200 shards of 3 headers: columns by name, one scan of all files."""
    heads = (["id", "text", "note"], ["note", "id", "text"], ["text", "id"])
    want = []
    for k in range(200):
        with open(tmp_path / f"s{k:03}.csv", "w", newline="") as f:
            w = csv.writer(f, lineterminator="\r\n" if k % 2 else "\n")
            w.writerow(heads[k % 3])
            for i, t, _ in rows(3, k):
                row = {"id": k * 10 + i, "text": t or "none", "note": f"n{i}"}
                w.writerow([row[c] for c in heads[k % 3]])
                want.append((row["id"], row["text"], row["note"] if k % 3 < 2 else None))
    df = C.union_shards(spark, C.list_shards(spark, str(tmp_path)), SCHEMA)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)
    from dossier.sources.csv_splits import blocks_of
    p = blocks_of(lines(spark, [str(tmp_path)], "UTF-8"))._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan text") == 1


def test_empty_files_and_empty_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,text\n\n1,x\n\n2,\"y\nz\"")
    got = C.union_shards(spark, [str(tmp_path)], SCHEMA)
    assert sorted(map(tuple, got.collect()), key=key) == [(1, "x", None), (2, "y\nz", None)]
    only = tmp_path / "none"
    only.mkdir()
    (only / "a.csv").write_text("id,text\n")
    assert C.union_shards(spark, [str(only)], SCHEMA).collect() == []
