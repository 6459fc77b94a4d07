"""Op3: exact round trips, segment faults, framing."""

import base64
import gzip
import hashlib

import pytest

from dossier.llm import warc as W
from dossier.session import scratch_path

SCHEMA = "page_id long, url string, html string, record_id string, payload string, Segment int"
LONG = "é€" * 40_000


def pages(spark):
    return spark.createDataFrame([
        (3, "http://a/3", "same", "", "", 1), (1, "http://a/1", "same", "", "", 1), (7, None, None, "", "", 1),
        (8, "x\r\nWARC-Type: response", "", "", "", 1), (None, "http://n", LONG, "", "", 1),
        (9, "http://a/9", LONG, "", "", 1), (9, "http://a/9", LONG, "", "", 1),
        (10, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n0\r\n\r\n", "", "", 1)], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


@pytest.mark.parametrize("sizes", [(1 << 20, 16 << 10, 4 << 10), (60_000, 100, 7), (50_000, 1000, 1000)])
def test_round_trip(spark, sizes):
    path = scratch_path(spark, "t-warc")
    W.write_archives(pages(spark), path, archive_bytes=sizes[0], segment_bytes=sizes[1], chunk_bytes=sizes[2])
    found = W.read_archives(spark, path)
    rows = found.collect()
    assert len(rows) == 8 and all(r.complete for r in rows)
    got = sorted((r.page or "", r.record_type, None if r.payload is None else r.payload.decode()) for r in rows)
    hostile = pages(spark).where("page_id = 10").first().html
    assert got == sorted([
        ("1", "response", "same"), ("3", "revisit", None), ("7", "response", ""), ("8", "revisit", None),
        ("9", "response", LONG), ("9", "revisit", None), ("", "revisit", None), ("10", "response", hostile)])
    out = {(r.page, r.record_type): (r.payload_bytes, r.payload_digest, r.refers_to) for r in W.resolved(found).collect()}
    assert out["3", "revisit"] == (4, digest("same"), "1")
    assert out[None, "revisit"] == (len(LONG.encode()), digest(LONG), "9")
    assert out["8", "revisit"] == (0, digest(""), "7")


def test_only_large_payloads_are_revisited(spark):
    path = scratch_path(spark, "t-warc")
    W.write_archives(pages(spark), path, min_revisit_bytes=5)
    kinds = [(r.page, r.record_type) for r in W.read_archives(spark, path).collect()]
    assert ("3", "response") in kinds and ("9", "revisit") in kinds


def test_empty_table(spark):
    path = scratch_path(spark, "t-warc")
    W.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert W.resolved(W.read_archives(spark, path)).collect() == []


def archive(tmp_path, name, parts, members=1):
    body = b"".join(p + b"\r\n\r\n" for p in parts)
    cut = len(body) // max(1, members)
    data = b"".join(gzip.compress(body[i:i + cut]) for i in range(0, len(body), cut)) if members else body
    (tmp_path / name).write_bytes(data)


def test_segments_over_archives_and_faults(spark, tmp_path):
    whole = [list(W.records(n, n, "u", "D", b"payload %d" % n * 50, n, 90, 11)) for n in range(5)]
    assert all(len(x) > 5 for x in whole)
    whole[1].pop(3)  # one missing
    whole[2].append(whole[2][2])  # one twice
    whole[3][-1] = whole[3][-1].replace(b"Total-Length: ", b"Total-Length: 1")  # another length
    whole[4].pop(0)  # no first record
    turned = [r for x in whole for r in x][::-1]
    info = W.record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:i>")], b"x: y")
    archive(tmp_path, "a.warc.gz", [info, *turned[::2]], members=3)
    archive(tmp_path, "b.warc", turned[1::2], members=0)
    rows = {r.page: r for r in W.read_archives(spark, str(tmp_path)).collect()}
    assert rows["0"].payload == b"payload 0" * 50 and rows["0"].complete
    for n in ("1", "2", "3", None):
        assert not rows[n].complete and rows[n].payload is None


@pytest.mark.parametrize("bad", [b"x", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc", b"WARC/1.1\r\nContent"])
def test_malformed_archives_are_errors(bad):
    with pytest.raises((ValueError, KeyError)):
        list(W.parsed(bad))


@pytest.mark.parametrize("bad", [b"", b"3\r\nabc", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n"])
def test_malformed_chunks_are_errors(bad):
    with pytest.raises(ValueError):
        W.dechunked(bad)
