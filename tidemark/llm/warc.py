"""WARC records in ZIP-packaged archives: writer, directory parser and
range reader.

A package is a ZIP file whose members are stored, not deflated:
``archive/data.warc.gz`` (one gzip member per WARC record) and
``indexes/index.cdxj`` (a line per record with its offset and length).  The
reader parses the end record, its ZIP64 form and the central directory, finds
the stored members, reads the index, and then reads ranges of records straight
from the package; nothing is unpacked to disk.

Packages are written by the tasks into the shared folder, under names no two
attempts share; the manifest, written through Spark, lists those that count.
So a lost executor leaves at most unlisted files.  Packages hold about
``package_bytes`` of payload, reads take about ``range_bytes`` each and are
dealt evenly over the tasks whatever package they lie in.

Of pages with equal payloads of at least ``least_bytes`` the one with the
smallest id is a ``response``; the others are ``revisit`` records that refer
to it and hold no payload.  Equal payloads are found by SHA-256 with an
aggregation, so a group of copies of any size costs one row per task.

Defined results: a null html is an empty payload; a null url an empty target;
null ids come after all others (a group of only null ids: all ``response``);
rows that share the smallest id are all ``response``; repeated rows give
repeated records; an empty table gives no package and an empty result; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import only, ship, text_or_empty
from tidemark.operators.skew import skewed_left_join
from tidemark.sources.scratch import materialise

PACKAGE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
# Fixed values of the formats.
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN, NO_ID = "urn:tidemark:page:", "urn:tidemark:no-page"
_END, _END64, _LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_AT = " 19700101000000 "
_MANIFEST = "path string, n_records bigint"
_RECORD = ("id string, uri string, record_type string, payload_bytes bigint, payload_digest string, "
           "refers string, payload binary")


# --- records --------------------------------------------------------------------

def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    return "".join(c if c.isprintable() else quote(c) for c in value)


def name_of(page: str | None) -> str:
    """A record's name: ids are percent-encoded, so that any text comes back."""
    return f"<{NO_ID}>" if page is None else f"<{URN}{quote(page, safe='')}>"


def page_of(name: str | None) -> str | None:
    return unquote(name[len(URN) + 1:-1]) if name and name.startswith(f"<{URN}") else None


def record(page: str | None, uri: str, payload: bytes, refers: str | None) -> bytes:
    """One WARC record; a revisit (``refers`` given) without its payload."""
    head = [f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {name_of(page)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {_one_line(uri)}",
            f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"Payload-Length: {len(payload)}",
            "Content-Type: text/html; charset=utf-8"]
    if refers is not None:
        head += [f"WARC-Refers-To: {name_of(refers)}", f"WARC-Profile: {PROFILE}"]
    body = payload if refers is None else b""
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(["WARC/1.1", *head, "", ""]).encode() + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of a record; a response's payload is checked against its
    digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]}")
    field = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    payload = rest[:int(field["Content-Length"])] if field["WARC-Type"] == "response" else None
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and (digest_of(payload) != digest or len(payload) != int(field["Payload-Length"])):
        raise ValueError(f"damaged payload of {field['WARC-Record-ID']}")
    return {"id": page_of(field["WARC-Record-ID"]), "uri": field["WARC-Target-URI"], "record_type": field["WARC-Type"],
            "payload_bytes": int(field["Payload-Length"]), "payload_digest": digest,
            "refers": page_of(field.get("WARC-Refers-To")), "payload": payload}


# --- packages -------------------------------------------------------------------

class Member(NamedTuple):
    """A stored member: where its bytes lie in the package."""

    start: int
    length: int


def members(read, size: int) -> dict[str, Member]:
    """The stored members of a package.  ``read(start, length)`` reads a range.

    The directory is found from the end: the end record (behind it at most a
    65,535-byte comment), and its ZIP64 form where a field is saturated.
    """
    tail_at = max(0, size - (1 << 16) - 22 - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END)
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        if at < 20 or tail[at - 20:at - 16] != _LOCATOR:
            raise ValueError("no ZIP64 locator")
        end64 = read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, at, out = read(start, length), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        local = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = directory[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, k)
            if kind == 1:  # the saturated fields, in this order
                wide, j = [full, packed, local], k + 4
                for i, top in enumerate((0xFFFFFFFF,) * 3):
                    if wide[i] == top:
                        wide[i] = struct.unpack_from("<Q", extra, j)[0]
                        j += 8
                full, packed, local = wide
            k += 4 + n
        at += 46 + n_name + n_extra + n_comment
        if method == 0 and packed == full and not flags & 1:
            header = read(local, 30)
            if header[:4] != b"PK\x03\x04":
                raise ValueError(f"no local header of {name}")
            out[name] = Member(local + 30 + sum(struct.unpack_from("<HH", header, 26)), full)
    return out


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write_package(path: str, rows: list[tuple[str | None, str, bytes, str | None]]) -> None:
    files, local = _file_system(path)
    index, at = [], 0
    with files.open_output_stream(local) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(ARCHIVE, "w", force_zip64=True) as member:
            for page, uri, payload, refers in rows:
                deflate = zlib.compressobj(3, zlib.DEFLATED, 31)
                data = deflate.compress(record(page, uri, payload, refers)) + deflate.flush()
                member.write(data)
                index.append(f"{name_of(page)}{_AT}" + json.dumps({"offset": at, "length": len(data)}))
                at += len(data)
        z.writestr(INDEX, "\n".join(index))
        z.writestr("datapackage.json", json.dumps({"resources": [{"path": ARCHIVE}, {"path": INDEX}]}))


def ranges_of(read, size: int, range_bytes: int = RANGE_BYTES) -> list[tuple[int, list[int]]]:
    """Start and record lengths of the ranges to read, by the index."""
    found = members(read, size)
    archive, index = found[ARCHIVE], found[INDEX]
    out: list[tuple[int, list[int]]] = []
    held = 0
    for line in read(index.start, index.length).decode().split("\n") if index.length else ():
        where = json.loads(line.rpartition(_AT)[2])
        if not out or held + where["length"] > range_bytes:
            out.append((archive.start + where["offset"], []))
            held = 0
        out[-1][1].append(where["length"])
        held += where["length"]
    return out


def records_in(data: bytes, lengths: list[int]) -> Iterator[dict]:
    """The records of a range: gzip members of these lengths."""
    at = 0
    for n in lengths:
        inflate = zlib.decompressobj(31)
        yield parse_record(inflate.decompress(data[at:at + n]) + inflate.flush())
        at += n


# --- Spark ------------------------------------------------------------------------

def roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
          least_bytes: int = 0) -> DataFrame:
    """Every page with the id it refers to (null: it is a response)."""
    df = only(pages, [page_id, url, html]).toDF("page_id", "url", "html")
    df = df.select("page_id", text_or_empty(F.col("url")).alias("url"), text_or_empty(F.col("html")).alias("html"))
    df = df.withColumn("payload_key", F.unhex(F.sha2(F.col("html").cast("binary"), 256)))
    groups = (df.where(F.octet_length("html") >= least_bytes).groupBy("payload_key")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null"))
    # Copies of one payload may be a third of all rows.
    return (skewed_left_join(df, groups.select("payload_key", "first"), ["payload_key"], outline=df.select("payload_key"))
            .select("page_id", "url", "html",
                    F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes packages of the rows of :func:`roles` below ``folder`` (a store
    all executors share) and returns their manifest."""
    ship(pages.sparkSession)
    files, local = _file_system(folder)
    files.create_dir(local, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def package(rows: list) -> pa.RecordBatch:
            path = f"{folder}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.wacz"
            _write_package(path, rows)
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [len(rows)]})

        rows, held = [], 0
        for batch in batches:
            for page, uri, html, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = html.encode()
                rows.append((page, uri, payload, refers))
                held += len(payload)
                if held >= package_bytes:
                    yield package(rows)
                    rows, held = [], 0
        if rows:
            yield package(rows)

    columns = pages.select(F.col("page_id").cast("string"), "url", "html", F.col("refers_to").cast("string"))
    return materialise(columns.mapInArrow(write, _MANIFEST), "manifest")


def read_archives(manifest: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of the packages the manifest lists."""
    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, local = _file_system(path)
                with files.open_input_file(local) as f:
                    read = lambda start, n: (f.seek(start), f.read(n))[1]  # noqa: B023, E731
                    found = ranges_of(read, f.size(), range_bytes)
                yield pa.RecordBatch.from_pydict({
                    "path": [path] * len(found), "start": pa.array([r[0] for r in found], pa.int64()),
                    "lengths": pa.array([r[1] for r in found], pa.list_(pa.int64()))})

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                files, local = _file_system(r["path"])
                with files.open_input_file(local) as f:
                    f.seek(r["start"])
                    rows = list(records_in(f.read(sum(r["lengths"])), r["lengths"]))
                if not payloads:
                    rows = [x | {"payload": None} for x in rows]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("id", pa.string()), ("uri", pa.string()), ("record_type", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers", pa.string()),
                    ("payload", pa.binary())]))

    spark = manifest.sparkSession
    ship(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = manifest.select("path").repartition(tasks).mapInArrow(plan, "path string, start bigint, lengths array<bigint>")
    return ranges.repartition(tasks).mapInArrow(fetch, _RECORD)


def round_trip(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as packages below ``folder`` and returns what reading
    them back gives, a row per page."""
    kind = dict(pages.dtypes)[page_id]
    read = read_archives(write_archives(roles(pages, page_id, url, html, least_bytes), folder), payloads=False)
    return read.select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers").cast(kind).alias("refers_to"))
