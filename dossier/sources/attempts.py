"""A table of the latest attempt per key, written by merge (K-7, U-B, R-7).

Rows lie in buckets by a hash of their key. An attempt rewrites only the buckets
it has rows for: old and new rows of a bucket are merged by key (the later
attempt wins, of the same attempt the new row), and a manifest, a small file per
version, names the folder of every bucket. Readers take the newest manifest, so
they see an attempt whole or not at all, and find one row per key without
looking at earlier attempts. Writing an attempt again, or one that a later one
has overtaken, changes nothing. Two writers at once can't both make the next
manifest; the second fails and may try again."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest: version, buckets, schema and the folder of each bucket."""
    fs, folder = _fs(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return None
    versions = sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".json"))
    if not versions:
        return None
    rows = spark.read.text(f"{path}/manifest/{versions[-1]}", wholetext=True).first()
    return json.loads(rows[0])


def _publish(spark: SparkSession, path: str, new: dict) -> None:
    fs, target = _fs(spark, f"{path}/manifest/{new['version']:08}.json")
    out = fs.create(target, False)  # fails if another writer was first
    try:
        out.write(bytearray(json.dumps(new).encode()))
    finally:
        out.close()


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per key, with its ``attempt``."""
    now = manifest(spark, path)
    if now is None:
        raise ValueError(f"no table at {path}")
    schema = TY.StructType.fromJson(now["schema"])
    if not now["folders"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in sorted(set(now["folders"].values()))])


def upsert(df: DataFrame, path: str, attempt: int, key: str = "candid", buckets: int = BUCKETS) -> None:
    """Merge one attempt's rows into the table at ``path`` (made if there is
    none). Of several rows of a key the greatest in order of the columns counts."""
    spark = df.sparkSession
    now = manifest(spark, path) or {"version": 0, "buckets": buckets, "folders": {}, "schema": None}
    rest = [c for c in df.columns if c != key]
    new = df.groupBy(key).agg(F.max(F.struct(F.lit(attempt).alias("attempt"), *rest)).alias("row"))
    bucket = F.pmod(F.xxhash64(key), F.lit(now["buckets"])).cast("int").alias("bucket")
    new = new.select(key, "row.*", bucket)
    version = f"data/{now['version'] + 1:08}-{uuid.uuid4().hex[:8]}"
    fresh = f"{path}/{version}-new"
    new.write.partitionBy("bucket").parquet(fresh)
    new = spark.read.schema(new.schema).parquet(fresh)
    touched = [r[0] for r in new.select("bucket").distinct().collect()]  # one number a bucket
    columns = [key, "attempt", *rest]
    old_folders = sorted({now["folders"][str(b)] for b in touched if str(b) in now["folders"]})
    merged = new.select(*columns, F.lit(1).alias("is_new"))
    if old_folders:
        old = spark.read.schema(new.drop("bucket").schema).parquet(*[f"{path}/{f}" for f in old_folders])
        merged = merged.unionByName(old.select(*columns, F.lit(0).alias("is_new")))
        row = F.max_by(F.struct("attempt", *rest), F.struct("attempt", "is_new")).alias("row")
        merged = merged.groupBy(key).agg(row).select(key, "row.*")
    merged.select(*columns, bucket).write.partitionBy("bucket").parquet(f"{path}/{version}")
    fs, old_copy = _fs(spark, fresh)
    fs.delete(old_copy, True)
    folders = now["folders"] | {str(b): f"{version}/bucket={b}" for b in touched}
    _publish(spark, path, {"version": now["version"] + 1, "buckets": now["buckets"], "folders": folders,
                           "schema": json.loads(new.select(*columns).schema.json())})


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes the folders of versions that the newest manifest doesn't name; how many."""
    now = manifest(spark, path)
    used = {f.split("/")[1] for f in now["folders"].values()} if now else set()
    fs, folder = _fs(spark, f"{path}/data")
    old = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName() not in used] if fs.exists(folder) else []
    for p in old:
        fs.delete(p, True)
    return len(old)
