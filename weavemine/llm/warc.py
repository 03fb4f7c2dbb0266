"""Operator 2: WARC, by way of a converter of legacy ARC archives.

An ARC file opens with a version block that names the fields of every header
line after it: version 1 has URL, IP, date, type and length, version 2 adds
result code, checksum, location, offset and file name. The converter reads a
line by the version in force, takes as many bytes as the line declares, and
synthesises what WARC wants: a record id from archive and offset, the date in
W3C form, the record type (response for HTTP, resource for the rest, warcinfo
for version blocks, revisit where the payload is archived elsewhere) and SHA-1
digests of block and payload.

Archives are real gzip-per-record files of bounded size in the shared folder,
written under names that are unique to a task attempt; only archives listed in
a written manifest count, so tasks that are lost or run twice leave no trace in
the result. Archive readers and writers stream: memory holds one record.

Defined results: null html is an empty payload; null url is written as
``urn:none``; white space and control characters in a url are percent-encoded;
null page ids rank below all others; repeated rows are records of their own and
among rows with the largest id the last by archive and place is the response;
an empty table gives no records. Columns other than the three read are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine.session import drop_path, materialize, scratch_path, table

NAME = "op2_arc_to_warc"
LEAST_REVISIT = 1000
ROLL = 32 << 20
LEVEL = 6
#: Fields of a header line by ARC version.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_ID = "X-Page-Id"
#: Schemes of Hadoop's connectors by the name that Arrow has for the same store.
ALIASES = {"s3a": "s3", "s3n": "s3"}


@dataclass
class ArcRecord:
    version: int
    offset: int
    fields: dict[str, str]
    content: bytes

    @property
    def url(self) -> str:
        return self.fields["URL"]

    def split_http(self) -> tuple[bytes, bytes] | None:
        """HTTP head (with its blank line) and payload; None where the content isn't an HTTP response."""
        if not self.content.startswith(b"HTTP/"):
            return None
        m = re.search(rb"\r?\n\r?\n", self.content)
        return (self.content, b"") if m is None else (self.content[: m.end()], self.content[m.end() :])


def http_header(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace") if m else None


def safe_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:none"


def arc_head(name: str, version: int, date: str) -> bytes:
    block = f"{version} 0 weavemine\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    return arc_record(f"filedesc://{name}", date, "text/plain", block, version, name, 0, code="200")


def arc_record(url: str, date: str, mime: str, content: bytes, version: int, name: str = "-", offset: int = 0, code: str = "200", ip: str = "0.0.0.0") -> bytes:
    more = f"{code} - - {offset} {name} " if version == 2 else ""
    return f"{url} {ip} {date} {mime} {more}{len(content)}\n".encode() + content + b"\n"


def parse_arc(stream: BinaryIO) -> Iterator[ArcRecord]:
    """Records of an uncompressed ARC stream, version blocks included. Raises ValueError at a line that no version explains."""
    version, at = None, 0
    while line := stream.readline():
        begin, at = at, at + len(line)
        if not line.strip():
            continue
        parts = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        if parts[0].startswith("filedesc:"):
            content = stream.read(int(parts[-1]))
            version = int(content.split(None, 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version}")
        names = ARC_FIELDS.get(version)
        if names is None or len(parts) < len(names):
            raise ValueError(f"not an ARC header line at {begin}: {line[:80]!r}")
        # a type may hold spaces: what is left of the fixed fields on both sides is the type
        after = len(names) - 4
        fields = dict(zip(names, [*parts[:3], " ".join(parts[3:-after]), *parts[-after:]]))
        length = int(fields["Archive-length"])
        if not parts[0].startswith("filedesc:"):
            content = stream.read(length)
        if len(content) < length:
            raise ValueError(f"{fields['URL']}: {length} bytes declared, {len(content)} there")
        at += length
        yield ArcRecord(version, begin, fields, content)


def sha1_name(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", sha1_name(block)), ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def convert(rec: ArcRecord, archive: str, refers: tuple[str, str, str] | None = None) -> bytes:
    """One ARC record as a WARC record; ``refers`` (record id, uri, date) makes it a revisit of that record."""
    d = rec.fields["Archive-date"].ljust(14, "0")
    date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
    headers = [("WARC-Type", ""), ("WARC-Record-ID", record_id(archive, rec.offset)), ("WARC-Date", date)]
    if rec.url.startswith("filedesc:"):
        headers[0] = ("WARC-Type", "warcinfo")
        info = f"software: weavemine\r\nformat: WARC File Format 1.1\r\nconverted-from: ARC/{rec.version}\r\n".encode()
        return warc_record([*headers, ("WARC-Filename", archive), ("Content-Type", "application/warc-fields")], info)
    headers += [("WARC-Target-URI", rec.url), ("WARC-IP-Address", rec.fields["IP-address"])]
    http = rec.split_http()
    if http is None:
        headers[0] = ("WARC-Type", "resource")
        return warc_record([*headers, ("WARC-Payload-Digest", sha1_name(rec.content)), ("Content-Type", rec.fields["Content-type"])], rec.content)
    head, payload = http
    headers += [("WARC-Payload-Digest", sha1_name(payload)), ("Content-Type", "application/http; msgtype=response")]
    if refers is None:
        headers[0] = ("WARC-Type", "response")
        return warc_record(headers, rec.content)
    headers[0] = ("WARC-Type", "revisit")
    to = [("WARC-Profile", REVISIT), ("WARC-Refers-To", refers[0]), ("WARC-Refers-To-Target-URI", refers[1]), ("WARC-Refers-To-Date", refers[2])]
    return warc_record(headers + to, head)


def parse_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of an uncompressed WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8").partition(":")
            headers[k.strip().lower()] = v.strip()
        block = stream.read(n := int(headers["content-length"]))
        if len(block) < n:
            raise ValueError(f"{headers.get('warc-record-id')}: cut short")
        yield headers, block


def _filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder as Spark names it, and the path there."""
    scheme, mark, rest = uri.partition("://")
    return pyarrow.fs.FileSystem.from_uri(ALIASES.get(scheme, scheme) + mark + rest)


def open_archive(uri: str) -> BinaryIO:
    """Streaming reader; gzip members one after another read as one stream."""
    fs, path = _filesystem(uri)
    raw = fs.open_input_stream(path, compression=None)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if uri.endswith(".gz") else raw


class _Archives:
    """Writes records to gzip-per-record archives of bounded size; ``done`` lists (uri, number of records)."""

    def __init__(self, folder: str, suffix: str, roll: int = ROLL):
        self.folder, self.suffix, self.roll = folder.rstrip("/"), suffix, roll
        self.attempt, self.out, self.size, self.records, self.offset = uuid.uuid4().hex, None, 0, 0, 0
        self.done: list[tuple[str, int]] = []

    def begin(self) -> str:
        self.close()
        self.name = f"{self.attempt}-{len(self.done):05d}.{self.suffix}.gz"
        fs, path = _filesystem(self.folder)
        fs.create_dir(path, recursive=True)
        self.out = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.size = self.records = self.offset = 0
        return self.name

    def write(self, record: bytes) -> None:
        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        data = z.compress(record) + z.flush()
        self.out.write(data)
        self.size += len(data)
        self.offset += len(record)
        self.records += 1

    @property
    def full(self) -> bool:
        return self.out is None or self.size >= self.roll

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.name}", self.records))
            self.out = None


def _manifest(archives: _Archives) -> Iterator[pa.RecordBatch]:
    archives.close()
    if archives.done:
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in archives.done], pa.string()), pa.array([n for _, n in archives.done], pa.int64())], ["archive", "records"])


def write_arc(pages: DataFrame, folder: str, date: str = "20260101000000", roll: int = ROLL) -> DataFrame:
    """Archive (page_id, url, html) as ARC files, versions 1 and 2 in turn; returns the manifest (lazy: write it once)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Archives(folder, "arc", roll)
        version = 1 + int(out.attempt[:8], 16) % 2
        for b in batches:
            for page, url, html in zip(b.column(0), b.column(1), b.column(2)):
                if out.full:
                    version = 3 - version
                    out.write(arc_head(out.begin(), version, date))
                payload = (html.as_py() or "").encode()
                mark = "" if page.as_py() is None else f"{PAGE_ID}: {page.as_py()}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}Content-Length: {len(payload)}\r\n\r\n"
                out.write(arc_record(safe_url(url.as_py()), date, "text/html", head.encode() + payload, version, out.name, out.offset))
        yield from _manifest(out)

    return pages.select("page_id", "url", "html").mapInArrow(run, "archive string, records long")


def index_arc(manifest: DataFrame) -> DataFrame:
    """(archive, offset, record_id, uri, date, page_id, payload_bytes, digest) of the HTTP records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows: dict[str, list] = {k: [] for k in ("archive", "offset", "record_id", "uri", "date", "page_id", "payload_bytes", "digest")}
                with open_archive(uri) as stream:
                    for rec in parse_arc(stream):
                        if (http := rec.split_http()) is None:
                            continue
                        page = http_header(http[0], PAGE_ID)
                        d = rec.fields["Archive-date"]
                        values = (uri, rec.offset, record_id(uri.rpartition("/")[2], rec.offset), rec.url, d, None if page is None else int(page), len(http[1]), hashlib.sha1(http[1]).digest())
                        for column, v in zip(rows.values(), values):
                            column.append(v)
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("uri", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.binary())]))

    return manifest.select("archive").mapInArrow(run, "archive string, offset long, record_id string, uri string, date string, page_id long, payload_bytes long, digest binary")


def revisits(index: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(archive, list of (offset, record id, uri, date referred to)): the records that repeat a payload of ``least`` bytes or more."""
    large = index.where(F.col("payload_bytes") >= least)
    best = large.groupBy("digest").agg(F.max(F.struct("page_id", "archive", "offset", "record_id", "uri", "date")).alias("best"), F.count("*").alias("n"))
    best = materialize(best.where("n > 1").select("digest", "best"), "warc-best")
    again = large.select("archive", "offset", "digest").join(best, "digest").where("NOT (archive = best.archive AND offset = best.offset)")
    return again.groupBy("archive").agg(F.collect_list(F.struct("offset", "best.record_id", "best.uri", "best.date")).alias("refers"))


def arc_to_warc(manifest: DataFrame, refers: DataFrame, folder: str) -> DataFrame:
    """Convert the ARC files of the manifest, one WARC file each; returns the new manifest (lazy: write it once)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Archives(folder, "warc", roll=1 << 62)
        for b in batches:
            for uri, again in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                name = uri.rpartition("/")[2]
                to = {}
                for r in again or ():
                    d = r["date"].ljust(14, "0")
                    to[r["offset"]] = (r["record_id"], r["uri"], f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z")
                out.begin()
                with open_archive(uri) as stream:
                    for rec in parse_arc(stream):
                        out.write(convert(rec, name, to.get(rec.offset)))
        yield from _manifest(out)

    # one archive is one unit of work; the list of an archive is no longer than the archive
    work = manifest.select("archive").join(refers, "archive", "left").select("archive", "refers")
    return spread(work).mapInArrow(run, "archive string, records long")


def read_warc(manifest: DataFrame) -> DataFrame:
    """(record_id, record_type, uri, page_id, payload_bytes, payload_digest, refers_to_id) of responses and revisits.

    Digests are bare lower-case hex; a response's is computed from its payload and must be the declared one.
    """
    names = ("record_id", "record_type", "uri", "page_id", "payload_bytes", "payload_digest", "refers_to_id")
    kinds = dict.fromkeys(names, pa.string()) | {"page_id": pa.int64(), "payload_bytes": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows: dict[str, list] = {k: [] for k in names}
                with open_archive(uri) as stream:
                    for h, block in parse_warc(stream):
                        kind = h["warc-type"]
                        if kind not in ("response", "revisit"):
                            continue
                        head, _, payload = block.partition(b"\r\n\r\n")
                        declared = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if kind == "response" and hashlib.sha1(payload).hexdigest() != declared:
                            raise ValueError(f"{h['warc-record-id']}: payload digest")
                        page = http_header(head, PAGE_ID)
                        size = len(payload) if kind == "response" else int(http_header(head, "Content-Length"))
                        values = (h["warc-record-id"], kind, h["warc-target-uri"], None if page is None else int(page), size, declared, h.get("warc-refers-to"))
                        for column, v in zip(rows.values(), values):
                            column.append(v)
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(list(kinds.items())))

    return manifest.select("archive").mapInArrow(run, "record_id string, record_type string, uri string, page_id long, payload_bytes long, payload_digest string, refers_to_id string")


def spread(manifest: DataFrame) -> DataFrame:
    """The manifest's rows dealt out evenly, so that each core has archives of its own; adaptive execution leaves a stated number alone."""
    spark = manifest.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return manifest.repartition(max(1, min(most, manifest.count())))


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Pages to ARC to WARC below ``folder``; returns the written WARC manifest (archive, records)."""
    spark = pages.sparkSession
    arcs = materialize(write_arc(pages, f"{folder}/arc"), "arc-manifest")
    index = materialize(index_arc(spread(arcs)), "arc-index")
    warcs = materialize(arc_to_warc(arcs, materialize(revisits(index), "warc-revisits"), f"{folder}/warc"), "warc-manifest")
    drop_path(spark, f"{folder}/arc")
    return warcs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    warcs = archive_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "archives"))
    back = materialize(read_warc(spread(warcs)), "warc-back")
    wanted = back.where("refers_to_id IS NOT NULL").select(F.col("refers_to_id").alias("_id")).distinct()
    named = back.select(F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to")).join(wanted, "_id", "left_semi")
    named = materialize(named, "warc-named")
    plain = back.where("refers_to_id IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    again = back.where("refers_to_id IS NOT NULL").join(named, F.col("refers_to_id") == F.col("_id"), "left").drop("_id")
    return plain.unionByName(again).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
best AS (SELECT payload_digest, max(page_id) AS best FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN best IS NOT NULL AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN best IS NOT NULL AND page_id <> best THEN best END AS refers_to
FROM p LEFT JOIN best USING (payload_digest)
"""
