"""WARC packages: round trips, ZIP64, walking without index, refusals."""

import base64
import hashlib
import io
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from pairscore.llm import warc_zip as w


class Held(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def member(payload: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(payload) + pack.flush()


def test_round_trip(spark):
    pages = [(i, f"http://h/{i}\r\nX: y", h) for i, h in enumerate([None, "", "a", "a", "b" * 100_000, "é", "a", "b" * 100_000])]
    pages += [(None, None, "a"), (None, "u", "only here"), (6, "again", "a")]
    df = spark.createDataFrame(pages, "record_id bigint, uri string, html string").withColumn("refers_to", F.lit("x"))
    records = df.withColumn("payload", w.as_payload(F.col("html"))).drop("html")
    got = w.read_packages(w.store(records)).collect()
    assert len(got) == len(pages)
    last = {"": 1, "a": 6, "b" * 100_000: 7, "é": 5, "only here": None}
    want = []
    for i, _, html in pages:
        body = (html or "").encode()
        first = last[html or ""]
        revisit = first is not None and i != first
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    key = lambda r: tuple(str(x) for x in r)
    names = ("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(key, ([r[n] for n in names] for r in got))) == sorted(map(key, want))
    assert {bytes(r["payload"]) for r in got if r["record_type"] == "response"} == {(h or "").encode() for h in last}


def test_smaller_payloads_are_not_revisited(spark):
    df = spark.createDataFrame([(1, "u", b"aa"), (2, "u", b"aa"), (3, "u", b"a"), (4, "u", b"a")], "record_id bigint, uri string, payload binary")
    got = {r["record_id"]: r["record_type"] for r in w.response_ids(df, min_bytes=2).collect()}
    assert got == {1: "revisit", 2: "response", 3: "response", 4: "response"}


def test_many_packages_and_listing(spark, tmp_path):
    rows = [(i, "u", "response", None, bytes([i]) * 1000) for i in range(50)]
    df = spark.createDataFrame(rows, "record_id bigint, uri string, record_type string, refers_to bigint, payload binary").coalesce(1)
    listed = w.write_packages(df, f"file://{tmp_path}", package_bytes=5000)
    assert listed.count() > 5 and listed.agg(F.sum("records")).first()[0] == 50
    found = w.find_packages(spark, f"file://{tmp_path}")
    assert sorted(r["record_id"] for r in w.read_packages(found).collect()) == list(range(50))


def test_empty_table(spark):
    df = spark.createDataFrame([], "record_id bigint, uri string, payload binary")
    assert w.read_packages(w.store(df)).count() == 0


def test_walking_without_index_and_extra_members():
    parts = [member(f"record {i}".encode() * 5000) for i in range(4)]
    held = Held()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_STORED) as z:
        z.writestr("readme.txt", "PK\5\6" * 10)
        z.writestr("more/x.warc.gz", b"".join(parts))
        z.comment = b"a comment with PK\5\6 inside"
    places = list(w.locate(held))
    assert [n for _, n in places] == [len(p) for p in parts]
    assert [held.getvalue()[s : s + n] for s, n in places] == parts


def test_zip64_directory():
    """A package whose end record defers everything to the ZIP64 end record and whose entry defers to its extra field."""
    body, name = member(b"hello"), b"archive/data.warc.gz"
    local = struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 4) + name + struct.pack("<2H", 9, 0)
    extra = struct.pack("<2H3Q", 1, 24, len(body), len(body), 0)
    entry = struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = len(local) + len(body)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, at + len(entry), 1)
    end = struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    held = Held(local + body + entry + end64 + locator + end)
    assert list(w.locate(held)) == [(len(local), len(body))]


def test_refusals():
    with pytest.raises(ValueError, match="end of central"):
        w.Directory(Held(b"no archive here"))
    held = Held()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.warc.gz", member(b"x" * 1000))
    with pytest.raises(ValueError, match="compressed"):
        list(w.locate(held))
    record = w.record_bytes(1, "u", "response", None, b"payload")
    with pytest.raises(ValueError, match="digest"):
        w.parse_record(record.replace(b"payload\r\n", b"paxload\r\n"))


def test_archives_are_read_back_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(w, "READ_BYTES", 20_000)
    noise = F.sha2(F.concat(F.col("id").cast("string"), F.lit("x")), 512)
    records = spark.range(2000).select(F.col("id").alias("record_id"), F.lit("http://a").alias("uri"), F.encode(noise, "UTF-8").alias("payload"))
    read = w.read_packages(w.store(records))
    by_task = read.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in by_task) == 2000 and len(by_task) >= 4
