"""WARC archives (operator 3): write pages as records, read them back.

**Writing.** Every row becomes one record. Of the rows with equal payloads of
at least ``min_revisit_bytes`` bytes, that with the smallest id (nulls last,
then the first row) is a ``response``; the others are ``revisit`` records that
refer to it and hold no payload. A response holds an HTTP message with a
chunked body; a block over ``segment_bytes`` goes on in ``continuation``
records, which name the first one (WARC-Segment-Origin-ID), their number, and
in the last of them the whole length. The archives are gzip files of about
``archive_bytes`` before compression, in a folder all executors share.

**Reading.** One task parses one archive (``spark.read`` brings the bytes, so
any store that Spark reads will do). Records that are whole are decoded where
they are read; only segments are shuffled: grouped by origin, ordered by
number, checked for gaps and against the total length, and the chunked framing
undone. A group is one record's own segments. A record whose segments are
missing, doubled or of another length in all has ``complete`` false and a null
payload; a malformed archive is an error.

Inputs and their results: a null or empty payload is an empty body; very long
payloads become many segments; repeated rows are records of their own; a null
id stays null; a null address leaves its header out; an empty table gives an
empty one; other columns are neither read nor returned.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dossier.llm.base import numbered, stage, table
from dossier.session import scratch_path

#: Production sizes, in bytes.
ARCHIVE, SEGMENT, CHUNK = 16 << 20, 16 << 10, 4 << 10
#: Bytes that a reading task hands on at once.
BATCH = 4 << 20

#: Fixed values of the formats.
HTTP_HEAD = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Transfer-Encoding: chunked\r\n\r\n")
RECORD_END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2000-01-01T00:00:00Z"


def base32_sha1(col: str | Column) -> Column:
    """The bare base32 SHA-1 of a binary column: ten hex digits are eight of base 32."""
    digest = F.sha1(col)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """Head and block of one record; the separator comes from the writer."""
    lines = [f"{k}: {v}" for k, v in [*fields, ("Content-Length", len(block))] if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block


def chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join([b"%x\r\n%b\r\n" % (len(p), p) for p in parts]) + b"0\r\n\r\n"


def records(rid: int, page: object, url: str | None, digest: str, payload: bytes | None, first: int,
            segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    def urn(n: int, k: int = 1) -> str:
        return f"<urn:record:{n}>" if k == 1 else f"<urn:record:{n}:{k}>"

    # an address must not end its header line
    url = None if url is None else "".join(url.splitlines())
    same = [("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Page-ID", page)]
    http = ("Content-Type", "application/http; msgtype=response")
    if payload is None:
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", urn(rid)), *same, http,
                      ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                      ("WARC-Refers-To", urn(first))], HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    cuts = range(0, len(block), segment_bytes)
    for k, at in enumerate(cuts, 1):
        part = block[at:at + segment_bytes]
        number = ("WARC-Segment-Number", k if len(cuts) > 1 else None)
        if k == 1:
            yield record([("WARC-Type", "response"), ("WARC-Record-ID", urn(rid)), *same, http, number], part)
        else:
            yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", urn(rid, k)), ("WARC-Date", DATE), number,
                          ("WARC-Segment-Origin-ID", urn(rid)),
                          ("WARC-Segment-Total-Length", len(block) if k == len(cuts) else None)], part)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE,
                   segment_bytes: int = SEGMENT, chunk_bytes: int = CHUNK) -> None:
    """Write every row of ``pages`` as a record to gzip archives in ``path``."""
    rows, rid = numbered(pages.select(
        F.col(id_col).cast("string").alias("page"), F.col(id_col).alias("id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload")), "pages")
    known = stage(rows.select(rid, "id", base32_sha1("payload").alias("digest"),
                              F.octet_length("payload").alias("size")), "page-digests")
    order = F.struct(F.isnull("id").alias("none"), "id", rid)
    first = known.where(F.col("size") >= min_revisit_bytes).groupBy("digest", "size").agg(F.min(order).alias("o"))
    roles = known.join(first, ["digest", "size"], "left").select(
        rid, "digest", F.coalesce(F.col(f"o.{rid}"), rid).alias("first"))
    total = known.agg(F.sum("size")).first()[0] or 0
    files = max(1, -(-total // archive_bytes))
    joined = rows.repartition(files, rid).join(roles.repartition(files, rid), rid).select(
        rid, "page", "url", "digest", "first",
        F.when(F.col("first") == F.col(rid), F.col("payload")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in (rid, "page", "url", "digest", "payload", "first"))):
                out = list(records(*row, segment_bytes, chunk_bytes))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    joined.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", RECORD_END).option("compression", "gzip").text(path)


def unzipped(data: bytes) -> bytes:
    """The content of a gzip file of any number of members, or plain bytes as they are."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        z = zlib.decompressobj(31)
        out.append(z.decompress(data))
        data = z.unused_data
    return b"".join(out)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    at = 0
    while data[at:at + 16].strip(b"\r\n"):
        head = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/1.", at) or head < 0:
            raise ValueError(f"no WARC record at byte {at}")
        pairs = [line.partition(":") for line in data[at:head].decode().split("\r\n")[1:]]
        fields = {k.strip().lower(): v.strip() for k, _, v in pairs}
        end = head + 4 + int(fields["content-length"])
        if end > len(data):
            raise ValueError(f"the record at byte {at} is cut short")
        yield fields, data[head + 4:end]
        at = end + 4


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("a chunk has no size line")
        size = int(body[at:line].partition(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = line + 2 + size
        if body[at:at + 2] != b"\r\n":
            raise ValueError("a chunk has another length than its size line says")
        out.append(body[line + 2:at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The entity body of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"\r\ntransfer-encoding: chunked" in head.lower() else body


FIELDS = ("warc-record-id", "warc-type", "page-id", "warc-target-uri", "warc-refers-to")
NAMES = ("record_id", "record_type", "page", "url", "refers_to")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, page, url, refers_to, payload, complete) for
    every response and revisit record of the archives in ``path``."""
    named = [T.StructField(n, T.StringType()) for n in NAMES]
    whole_schema = T.StructType([*named, T.StructField("payload", T.BinaryType()),
                                 T.StructField("complete", T.BooleanType())])
    part_schema = T.StructType([*named, T.StructField("origin", T.StringType()), T.StructField("segment", T.LongType()),
                                T.StructField("total", T.LongType()), T.StructField("block", T.BinaryType())])

    def whole_record(f: dict[str, str], block: bytes) -> dict | None:
        if "warc-segment-number" in f or f["warc-type"] not in ("response", "revisit"):
            return None
        return {"payload": payload_of(block) if f["warc-type"] == "response" else None, "complete": True}

    def part_record(f: dict[str, str], block: bytes) -> dict | None:
        if "warc-segment-number" not in f or f["warc-type"] not in ("response", "continuation"):
            return None
        total = f.get("warc-segment-total-length")
        return {"origin": f.get("warc-segment-origin-id", f["warc-record-id"]), "block": block,
                "segment": int(f["warc-segment-number"]), "total": None if total is None else int(total)}

    def scan(take: Callable[[dict, bytes], dict | None], schema: T.StructType) -> DataFrame:
        def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            arrow = to_arrow_schema(schema)
            for b in batches:
                for data in b.column("content"):
                    rows, held = [], 0
                    for f, block in parsed(unzipped(data.as_py())):
                        if (row := take(f, block)) is None:
                            continue
                        rows.append(dict(zip(NAMES, map(f.get, FIELDS))) | row)
                        held += len(block)
                        if held > BATCH:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, arrow)

        return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, schema)

    # two scans cost less than one whose payloads are kept for two uses
    whole = scan(whole_record, whole_schema)

    parts = F.sort_array(F.collect_list(F.struct("segment", "block")))
    head = [F.min(F.when(F.col("segment") == 1, F.col(n))).alias(n) for n in NAMES]
    grouped = scan(part_record, part_schema).groupBy("origin").agg(
        *head, parts.alias("parts"), F.max("total").alias("total"), F.max("segment").alias("last"))
    blocks = grouped.select(*NAMES, "total", "last", F.size("parts").alias("n"),
                            F.size(F.array_distinct(F.col("parts.segment"))).alias("distinct"),
                            F.aggregate("parts", F.lit(b"").cast("binary"),
                                        lambda a, p: F.concat(a, p["block"])).alias("block"))
    right = ((F.col("n") == F.col("last")) & (F.col("n") == F.col("distinct")) & F.col("record_id").isNotNull()
             & (F.octet_length("block") == F.col("total")))
    blocks = blocks.withColumn("complete", F.coalesce(right, F.lit(False)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payloads = [payload_of(x) if ok else None for x, ok in
                        zip(b.column("block").to_pylist(), b.column("complete").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in NAMES), pa.array(payloads, pa.binary()),
                                              b.column("complete")], [*NAMES, "payload", "complete"])

    joined = blocks.select(*NAMES, "block", "complete").mapInArrow(decode, whole.schema)
    return whole.unionByName(joined)


def resolved(found: DataFrame) -> DataFrame:
    """(page, payload_bytes, payload_digest, record_type, refers_to) per
    record; a revisit has the figures, and as refers_to the page, of the
    response that it refers to."""
    small = stage(found.select("record_id", "record_type", "page", "refers_to",
                               F.octet_length("payload").cast("long").alias("payload_bytes"),
                               base32_sha1("payload").alias("payload_digest")), "record-digests")
    responses = small.where("record_type = 'response'")
    of = responses.select(F.col("record_id").alias("refers_to"), F.col("page").alias("of_page"), "payload_bytes",
                          "payload_digest")
    revisits = small.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(of, "refers_to", "left")
    return responses.select("page", "payload_bytes", "payload_digest", "record_type",
                            F.lit(None).cast("string").alias("refers_to")).unionByName(
        revisits.select("page", "payload_bytes", "payload_digest", "record_type", F.col("of_page").alias("refers_to")))


def op3_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return resolved(read_archives(spark, path)).select(
        F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


OP3_SQL = f"""
WITH hexed AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
digits AS (SELECT page_id, payload, [
             (('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31
             for i in range(0, 32)] AS d FROM hexed),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM digits)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string([substr('{BASE32}', x::INT + 1, 1) for x in d], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts"""

QUERIES = {"op3_warc_segments": op3_warc_segments}
ORACLE = {"op3_warc_segments": OP3_SQL}
