"""Multi-line CSV read by many tasks per file, whatever the files' headers (S-1,
S-7, K-2, U-A).

Spark's ``multiLine`` reader takes a file as one task, since a line break may lie
inside quotes. But quotes are doubled to stand for themselves, so a line break
ends a record exactly if an even number of quotes stands before it in the file.
Files are read as lines, which Spark splits by blocks of bytes:

1. one pass counts, per block, the lines with an odd number of quotes, and keeps
   each file's first line, its header. The parities, summed over a file's
   blocks, tell for every block whether it starts inside quotes;
2. a second pass forms the records of each block. What a block's first or last
   record lacks stands in its neighbours: these fragments, at most two a block,
   carry the block where their record starts and are put together by it;
3. each record is parsed by ``from_csv`` with the columns in the order of its
   file's header, and columns are matched by name. Files of the same header
   share one parser; there is one scan, however many files and headers.

The blocks of both passes are the same, as both scans read the same files with
the same settings; a block that the first pass has not seen stops the job.
Encodings are those in which quotes and line feeds are single bytes (UTF-8,
Latin-1 and its kin); records end with a line feed or with carriage return and
line feed; empty lines are no records."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from dossier.operators.joins import checked_broadcast
from dossier.session import materialize

#: Distinct headers that one scan parses; more are an error in the files.
MAX_HEADERS = 200


def lines(spark: SparkSession, paths: Sequence[str], encoding: str) -> DataFrame:
    """(file, block, value): the lines of all files, in order within a block."""
    raw = spark.read.option("lineSep", "\n").text(list(paths))
    value = F.col("value")
    if encoding.upper().replace("-", "") != "UTF8":
        value = F.decode(F.col("value").cast("binary"), encoding)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      value.alias("value"))


def blocks_of(text: DataFrame) -> DataFrame:
    """Per block (file, block): header (of its file's first line, else null),
    whether it starts inside quotes (``open``), and in which block the record
    starts that is open there (``chain``)."""
    odd = F.length(F.regexp_replace("value", '[^"]+', "")) % 2
    found = text.withColumn("at", F.monotonically_increasing_id()).groupBy("file", "block").agg(
        F.sum(odd.cast("long")).alias("odd"), F.min_by("value", "at").alias("line"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("open", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    # a record starts in the block and is open at its end
    starts = ((F.col("open") + F.col("odd")) % 2 == 1) & ((F.col("open") == 0) | (F.col("odd") > 0))
    found = found.withColumn("starts", F.when(starts, F.col("block")))
    return found.select("file", "block", F.when(F.col("block") == 0, F.col("line")).alias("line"),
                        (F.col("open") == 1).alias("open"), F.last("starts", True).over(before).alias("chain"))


def records(text: DataFrame, blocks: DataFrame) -> DataFrame:
    """(file, first, record): every record, ``first`` for a file's first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pending, open_, inside, seen = None, [], False, False, 0
        chain = None
        out: list[tuple] = []

        def close() -> None:
            """The rest of a block: the start or the middle of a record, or its last line."""
            if now is not None and pending:
                if inside or open_:
                    out.append((now[0], now[1], False, chain if inside else now[1], "\n".join(pending)))
                else:
                    out.append((now[0], now[1], now[1] == 0 and seen == 0, None, "\n".join(pending)))
        for b in batches:
            values = b.column("value")
            odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) & 1
            files, at, opened, chains = (b.column(c).to_pylist() for c in ("file", "block", "open", "chain"))
            texts, i = values.to_pylist(), 0
            while i < len(texts):
                if now != (files[i], at[i]):
                    close()
                    if opened[i] is None:
                        raise ValueError("the blocks of the files have changed between two passes")
                    now, pending, open_, seen = (files[i], at[i]), [], opened[i], 0
                    inside, chain = open_, chains[i]
                j = i
                while j < len(texts) and at[j] == now[1] and files[j] == now[0]:
                    j += 1
                parity = (np.cumsum(odd[i:j]) + open_) & 1
                start = i
                for e in np.flatnonzero(parity == 0) + i:
                    pending.extend(texts[start:e + 1])
                    text = pending[0] if len(pending) == 1 else "\n".join(pending)
                    out.append((*now, not inside and now[1] == 0 and seen == 0, chain if inside else None, text))
                    pending, inside, seen, start = [], False, seen + 1, e + 1
                pending.extend(texts[start:j])
                open_, i = bool(parity[-1]), j
            if len(out) > 10_000:
                yield batch(out)
                out = []
        close()
        yield batch(out)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        types = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                          ["file", "block", "first", "chain", "record"])

    known = checked_broadcast(blocks.select("file", "block", "open", "chain"), 1_000_000)
    got = materialize(text.join(known, ["file", "block"], "left").mapInArrow(
        run, "file string, block long, first boolean, chain long, record string"), "records")
    whole = got.where("chain is null").select("file", "first", "record")
    parts = F.array_sort(F.collect_list(F.struct("block", "record")))
    joined = got.where("chain is not null").groupBy("file", "chain").agg(parts.alias("parts")).select(
        "file", F.lit(False).alias("first"), F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined).where(~F.col("record").isin("", "\r"))


def header_columns(line: str) -> list[str]:
    return next(csv.reader([line.removesuffix("\r").removeprefix("\ufeff")]), [])


def by_name(record: Column, columns: list[str], types: dict[str, TY.DataType], options: dict[str, str]) -> Column:
    """A record with the given columns as a struct of ``types`` in their order."""
    ddl = ", ".join(f"`{c.replace('`', '``')}` {types.get(c, TY.StringType()).simpleString()}" for c in columns)

    def picked(row: Column) -> Column:
        return F.struct(*[(row[c] if c in columns else F.lit(None).cast(t)).alias(c) for c, t in types.items()])
    # transform over one value names the parsed row, so it isn't parsed once per column
    return F.get(F.transform(F.array(F.from_csv(record, ddl, options)), picked), F.lit(0))


def read_splits(spark: SparkSession, paths: Sequence[str], options: dict[str, str], encoding: str = "UTF-8",
                schema: TY.StructType | None = None) -> DataFrame:
    """All records of the files below ``paths``; columns are matched by name with
    ``schema`` (missing ones are null, others are left out; without a schema, all
    columns of all headers as strings). The rows of all files are kept."""
    text = lines(spark, paths, encoding)
    blocks = materialize(blocks_of(text), "csv-blocks")
    found = blocks.where("line is not null")
    heads = [r["line"] for r in found.select("line").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(heads) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers")
    if schema is None:
        names = list(dict.fromkeys(c for h in sorted(heads) for c in header_columns(h)))
        schema = TY.StructType([TY.StructField(c, TY.StringType()) for c in names])
    if not heads:
        return spark.createDataFrame([], schema)
    types = {f.name: f.dataType for f in schema.fields}
    parse = {k: v for k, v in options.items() if k != "header"}
    record = F.regexp_replace("record", "\r\\z", "")
    fields = None
    for h in heads:
        made = by_name(record, header_columns(h), types, parse)
        is_it = F.col("line") == h
        fields = F.when(is_it, made) if fields is None else fields.when(is_it, made)
    rows = records(text, blocks).where("not first").join(checked_broadcast(found.select("file", "line"), 1_000_000), "file")
    return rows.select(fields.alias("r")).select("r.*")

