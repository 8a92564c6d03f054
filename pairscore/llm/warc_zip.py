"""WARC records in ZIP packages: write, locate, read by range.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdx``
(offset, length and record id per line), both stored without compression, so a record's place
in the package is the member's place plus the record's offset. The reader parses the end
record, the ZIP64 locator and end record, and the central directory, each by a ranged read;
takes record places from the index, or walks the member where a package has none; and reads
records by ranges. Nothing is extracted, and no package is held in memory.

Packages are opened through ``pyarrow.fs``, by the address that Spark lists them with.
Null payloads are empty payloads. Records with a null id are written and read like others.
Empty tables give no packages, and reading none gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, work_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Payload bytes of a package, about; a record is never divided.
PACKAGE_BYTES = 32 << 20
#: Index entries that travel as one unit of reading.
RUN = 256
#: Stored bytes that one task reads back, about.
READ_BYTES = 8 << 20

RECORDS = "record_id bigint, uri string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
PLACES = "package string, start bigint, places array<struct<start:bigint,length:bigint>>"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of an address as Spark prints it."""
    if re.match("file:/[^/]", uri):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def response_ids(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` plus record_type and refers_to: of equal payloads of at least ``min_bytes``, the largest id is the response.

    Rows that share the largest id are all responses. Where all ids of a payload are null, all are responses.
    Payloads count as equal by SHA-256 and length. The ids are reduced per payload before the join, whose
    large side may be split.
    """
    keyed = records.withColumn("payload", F.coalesce("payload", F.lit(b"")))
    keyed = keyed.withColumn("_key", F.concat(F.sha2("payload", 256), F.octet_length("payload").cast("string")))
    first = keyed.groupBy(F.col("_key").alias("_of")).agg(F.max("record_id").alias("_first"))
    joined = keyed.join(first, F.col("_key") == F.col("_of"), "left")
    revisit = (
        (F.octet_length("payload") >= min_bytes)
        & F.col("_first").isNotNull()
        & ~F.col("record_id").eqNullSafe(F.col("_first"))
    )
    return joined.withColumns(
        {
            "record_type": F.when(revisit, "revisit").otherwise("response"),
            "refers_to": F.when(revisit, F.col("_first")),
        }
    ).drop("_key", "_of", "_first")


def one_line(text: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", text or "")


def record_bytes(record_id, uri, record_type, refers_to, payload: bytes) -> bytes:
    """One WARC record; a revisit carries the digest and size of its payload, not the payload."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <urn:record:{'' if record_id is None else record_id}>",
        f"WARC-Target-URI: {one_line(uri)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    body = payload
    if record_type == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:record:{refers_to}>",
        ]
        body = b""
    head += [f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:] if ": " in line)}
    size = int(fields["content-length"])
    payload = rest[:size]
    if len(payload) != size:
        raise ValueError("a WARC record is cut short")
    number = lambda name: int(m.group(1)) if (m := re.match(r"<urn:record:(-?\d+)>", fields.get(name, ""))) else None
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and base32_sha1(payload) != stated:
        raise ValueError("a payload does not have its digest")
    return {
        "record_id": number("warc-record-id"),
        "uri": fields.get("warc-target-uri", ""),
        "record_type": fields["warc-type"],
        "refers_to": number("warc-refers-to"),
        "payload_bytes": int(fields.get("x-payload-length", size)),
        "payload_digest": stated,
        "payload": payload,
    }


class Package:
    """Collects records, then writes one package under a name of its own."""

    def __init__(self):
        self.data, self.index, self.size = io.BytesIO(), [], 0

    def add(self, record_id, record: bytes) -> None:
        packed = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packed.compress(record) + packed.flush()
        self.index.append(json.dumps({"id": record_id, "offset": self.data.tell(), "length": len(member)}))
        self.data.write(member)
        self.size += len(record)

    def write(self, folder: str) -> dict:
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        with system.open_output_stream(f"{path}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
            with package.open(DATA, "w", force_zip64=True) as member:
                member.write(self.data.getbuffer())
            package.writestr(INDEX, "\n".join(self.index) + "\n")
        return {"package": f"{folder}/{name}", "records": len(self.index)}


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes (record_id, uri, record_type, refers_to, payload) as packages below ``folder``; returns their stored list.

    Only packages in the list count: what a lost task left is in no list. Tasks read their rows as they come
    and hold one package at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = Package(), []
        for batch in batches:
            for row in batch.to_pylist():
                payload = row["payload"] or b""
                package.add(row["record_id"], record_bytes(row["record_id"], row["uri"], row["record_type"], row["refers_to"], payload))
                if package.size >= package_bytes:
                    done.append(package.write(folder))
                    package = Package()
        if package.index:
            done.append(package.write(folder))
        yield pa.RecordBatch.from_pylist(done, pa.schema([("package", pa.string()), ("records", pa.int64())]))

    wanted = records.select(
        F.col("record_id").cast("long"), "uri", "record_type", F.col("refers_to").cast("long"), "payload"
    )
    return materialize(wanted.mapInArrow(run, "package string, records bigint"), "packages")


class Directory:
    """The members of a ZIP file, from ranged reads of its end and its central directory."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        tail_at = max(0, self.size - 65_557)
        tail = self.at(tail_at, self.size - tail_at)
        end = tail.rfind(b"PK\5\6")
        while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
            end = tail.rfind(b"PK\5\6", 0, end)  # bytes of a comment that look like a signature
        if end < 0:
            raise ValueError("no end of central directory")
        count, size, start = struct.unpack("<H2I", tail[end + 10 : end + 20])
        if tail[end - 20 : end - 16] == b"PK\6\7" and end >= 20:
            (at,) = struct.unpack("<Q", tail[end - 12 : end - 4])
            record = self.at(at, 56)
            if record[:4] != b"PK\6\6":
                raise ValueError("no ZIP64 end record where its locator points")
            count, size, start = struct.unpack("<3Q", record[32:56])
        self.count, self.length, self.start = count, size, start

    def at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def members(self) -> Iterator[dict]:
        """name, method, size and header place of each member; the directory is read in pieces."""
        at, end, left = self.start, self.start + self.length, b""
        for _ in range(self.count):
            while len(left) < 46 or len(left) < 46 + sum(struct.unpack("<3H", left[28:34])):
                more = self.at(at, min(1 << 20, end - at))
                if not more:
                    raise ValueError("the central directory is cut short")
                left, at = left + more, at + len(more)
            if left[:4] != b"PK\1\2":
                raise ValueError("not a central directory entry")
            flags, method = struct.unpack("<2H", left[8:12])
            packed, size, name_len, extra_len, note_len = struct.unpack("<2I3H", left[20:34])
            (header,) = struct.unpack("<I", left[42:46])
            name = left[46 : 46 + name_len]
            extra = left[46 + name_len : 46 + name_len + extra_len]
            wide = self.zip64(extra)
            take = lambda value: wide.pop(0) if value == 0xFFFFFFFF else value  # noqa: E731  in the order size, packed, header
            size, packed, header = take(size), take(packed), take(header)
            left = left[46 + name_len + extra_len + note_len :]
            yield {
                "name": name.decode("utf-8" if flags & 0x800 else "cp437"),
                "method": method,
                "size": packed,
                "header": header,
            }

    @staticmethod
    def zip64(extra: bytes) -> list[int]:
        at = 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack("<2H", extra[at : at + 4])
            if kind == 1:
                return list(struct.unpack(f"<{size // 8}Q", extra[at + 4 : at + 4 + size // 8 * 8]))
            at += 4 + size
        return []

    def data_start(self, member: dict) -> int:
        """Where a stored member's bytes begin, after its local header."""
        if member["method"] != 0:
            raise ValueError(f"{member['name']} is compressed; only stored members can be read by range")
        local = self.at(member["header"], 30)
        if local[:4] != b"PK\3\4":
            raise ValueError("not a local header")
        return member["header"] + 30 + sum(struct.unpack("<2H", local[26:30]))


def index_lines(directory: Directory, start: int, size: int) -> Iterator[dict]:
    """The entries of an index member, read in pieces."""
    left, at = b"", start
    while at < start + size:
        more = directory.at(at, min(1 << 20, start + size - at))
        at += len(more)
        *lines, left = (left + more).split(b"\n")
        yield from (json.loads(line) for line in lines if line.strip())
    if left.strip():
        yield json.loads(left)


def walked(directory: Directory, start: int, size: int) -> Iterator[tuple[int, int]]:
    """Places of the gzip members of a record member without index."""
    at, end = start, start + size
    while at < end:
        inflate, begin = zlib.decompressobj(31), at
        while not inflate.eof:
            chunk = directory.at(at, min(1 << 16, end - at))
            if not chunk:
                raise ValueError("a record is cut short")
            inflate.decompress(chunk)
            at += len(chunk)
        at -= len(inflate.unused_data)
        yield begin - start, at - begin


def locate(file) -> Iterator[tuple[int, int]]:
    """(start in the package, length) of every record of a package."""
    directory = Directory(file)
    members = {m["name"]: m for m in directory.members()}
    for name, member in sorted(members.items()):
        if not name.endswith(".warc.gz"):
            continue
        start = directory.data_start(member)
        index = members.get(INDEX) if name == DATA else None
        if index is not None:
            lines = index_lines(directory, directory.data_start(index), index["size"])
            places = ((x["offset"], x["length"]) for x in lines)
        else:
            places = walked(directory, start, member["size"])
        for offset, length in places:
            yield start + offset, length


def list_records(packages: DataFrame) -> DataFrame:
    """The places of all records, ``RUN`` neighbours to a row, from the column ``package``."""

    def run(batches):
        for batch in batches:
            for name in batch.column("package").to_pylist():
                system, path = opened(name)
                with system.open_input_file(path) as file:
                    rows: list = []
                    for start, length in locate(file):
                        rows.append({"start": start, "length": length})
                        if len(rows) == RUN:
                            yield run_row(name, rows)
                            rows = []
                    if rows:
                        yield run_row(name, rows)

    return packages.select("package").mapInArrow(run, PLACES)


def run_row(name: str, rows: list[dict]) -> pa.RecordBatch:
    place = pa.struct([("start", pa.int64()), ("length", pa.int64())])
    schema = pa.schema([("package", pa.string()), ("start", pa.int64()), ("places", pa.list_(place))])
    return pa.RecordBatch.from_pylist([{"package": name, "start": rows[0]["start"], "places": rows}], schema)


def read_records(places: DataFrame) -> DataFrame:
    """The records at ``places``, each by one ranged read."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(RECORDS))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, path = opened(row["package"])
                with system.open_input_file(path) as file:
                    held, size = [], 0
                    for place in row["places"]:
                        file.seek(place["start"])
                        held.append(parse_record(zlib.decompress(file.read(place["length"]), 31)))
                        size += len(held[-1]["payload"])
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    return places.mapInArrow(run, RECORDS)


def read_packages(packages: DataFrame) -> DataFrame:
    """All records of the packages; the places are dealt out anew so that large packages are read by many tasks."""
    places = materialize(list_records(packages), "warc-places")
    stored = F.aggregate("places", F.lit(0).cast("bigint"), lambda acc, p: acc + p["length"])
    size = places.agg(F.sum(stored)).first()[0] or 0
    # places are small and would be put into one task; what they stand for decides
    return read_records(places.repartition(size // READ_BYTES + 1, "package", "start"))


def find_packages(spark: SparkSession, folder: str) -> DataFrame:
    """The packages below a folder, listed without reading them."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
    return found.load(folder).select(F.col("path").alias("package"))


def store(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Dedupe, write and list: the packages of (record_id, uri, payload) in a folder of the session's shared work folder."""
    folder = work_folder(records.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = "file://" + folder
    return write_packages(response_ids(records.select("record_id", "uri", "payload"), min_bytes), folder)


def as_payload(text: Column) -> Column:
    return F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))
