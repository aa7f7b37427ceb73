"""Operator 2: legacy ARC archives, converted to WARC and read back.

Pages are written as ARC archives (versions 1 and 2, a gzip member for each record) to the shared
folder. The converter reads each archive as a stream: the version block tells which fields a header line
has, the declared length tells where a record ends. It makes up what WARC asks for and ARC lacks:
record ids (from archive and place, so that a repeated task makes the same), timestamps, types and payload
digests. Only metadata rows are shuffled; payloads go from file to file. Files are written under another
name and moved into place when complete, so a lost task is simply run again.

Defined results: a null html is the empty payload; a null url is written as `urn:none`. Of equal payloads
the record of the smallest (page_id, archive, place) is the response, where null page_ids come last; so one of
repeated rows is the response and the others are revisits. Further columns are not read.
"""

from __future__ import annotations

import atexit
import base64
import gzip
import hashlib
import io
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import cut, remove, shared_dir, slices, spread, table

ARCHIVE_BYTES, MOST_TASKS, LEVEL, CAPTURED, NO_URL = 64 << 20, 100_000, 1, "20240101000000", "urn:none"
#: The fields of an ARC header line by version.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ROW, REFERS_ROW = "X-Archive-Row", "X-Refers-To-Row"


class Output:
    """A file of the shared folder that appears under its name when closed."""

    def __init__(self, folder: str, name: str):
        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self.name, self.path, self.held = name, posixpath.join(root, name), posixpath.join(root, f".{name}.{uuid.uuid4().hex}")
        self.out, self.size, self.raw = self.fs.open_output_stream(self.held, compression=None), 0, 0

    def member(self, data: bytes) -> int:
        """Append a gzip member; gives its place."""
        at, packed = self.size, gzip.compress(data, LEVEL, mtime=0)
        self.out.write(packed)
        self.size, self.raw = at + len(packed), self.raw + len(data)
        return at

    def close(self) -> None:
        self.out.close()
        try:
            self.fs.move(self.held, self.path)
        except OSError:  # a store that moves nothing onto a file: an earlier attempt of the task left it
            self.fs.delete_file(self.path)
            self.fs.move(self.held, self.path)


def opened(folder: str, name: str) -> io.BufferedReader:
    fs, root = pafs.FileSystem.from_uri(folder)
    return io.BufferedReader(gzip.GzipFile(fileobj=fs.open_input_stream(posixpath.join(root, name), compression=None)), 1 << 20)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_url(url: str | None) -> str:
    return quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url else NO_URL


def version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 larkspur\n{ARC_FIELDS[version]}\n"
    tail = f" {len(body)}\n" if version == 1 else f" 200 - - 0 {name} {len(body)}\n"
    return f"filedesc://{name} 0.0.0.0 {CAPTURED} text/plain{tail}{body}\n".encode()


def arc_record(url: str, body: bytes, version: int, name: str, offset: int, mime: str = "text/html", date: str = CAPTURED) -> bytes:
    middle = "" if version == 1 else f"200 {hashlib.md5(body).hexdigest()} - {offset} {name} "
    return f"{url} 0.0.0.0 {date} {mime} {middle}{len(body)}\n".encode() + body + b"\n"


@dataclass
class ArcRecord:
    fields: dict[str, str]
    body: bytes
    version: int


#: Fixed value: what the date of a record looks like.
DATE = re.compile(r"[0-9]{14}")


def arc_header(line: bytes, fields: list[str]) -> dict[str, str] | None:
    """The fields of an ARC header line, or None if it is none. Only the URL may hold spaces."""
    values = line.decode(errors="replace").rstrip("\r\n").rsplit(" ", len(fields) - 1)
    got = dict(zip(fields, values, strict=False))
    good = len(values) == len(fields) and got["URL"] and got["Archive-length"].isdecimal() and DATE.fullmatch(got["Archive-date"])
    return got if good else None


def read_arc(stream: io.BufferedReader, bad: list[bytes] | None = None) -> Iterator[ArcRecord]:
    """The records after the version block. Header lines have the fields that the version block names.

    A line that is no header where one must stand, or a body that ends too soon, is an error; with `bad` it is put there, and reading goes on at the next header line."""
    first = stream.readline()
    if not first.startswith(b"filedesc://"):
        raise ValueError("an ARC archive begins with a version block")
    block = stream.read(int(first.split()[-1]))
    about, names = block.decode().splitlines()[:2]
    version, fields = int(about.split()[0]), names.split()
    if version not in ARC_FIELDS:
        raise ValueError(f"ARC version {version} is not known")
    while line := stream.readline():
        if line in (b"\n", b"\r\n"):
            continue
        got, body = arc_header(line, fields), b""
        if got is not None:
            body = stream.read(n := int(got["Archive-length"]))
        if got is None or len(body) != n:
            if bad is None:
                raise ValueError(f"not a header line of ARC version {version}: {line[:200]!r}" if got is None else f"an ARC record declares {n} bytes and has {len(body)}")
            bad.append(line)
            continue
        yield ArcRecord(got, body, version)


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return dict(x.split(": ", 1) for x in lines), payload


def warc_record(kind: str, record_id: str, uri: str, date: str, digest: str, block: bytes, more: dict[str, str]) -> bytes:
    iso = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{record_id}>", "WARC-Date": iso, "WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{base32_sha1(block)}", "Content-Type": "application/http; msgtype=response", **more, "Content-Length": str(len(block))}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def read_warc(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record; a block that does not match its digest is an error."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not re.match(rb"WARC/1\.[01]\r\n", line):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            head[k] = v
        block = stream.read(int(head["Content-Length"]))
        if f"sha1:{base32_sha1(block)}" != head["WARC-Block-Digest"]:
            raise ValueError(f"record {head['WARC-Record-ID']} does not match its digest")
        yield head, block


def record_id(archive: str, place: int) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"arc:{archive}#{place}"))


def tasks_of(rows: DataFrame, archives: int) -> int:
    """Tasks for so many archives: about two for each, so that hashing seldom puts several together, up to MOST_TASKS. Given outright, since adaptive execution would merge them by the size of the metadata."""
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(2 * archives, max(usual, MOST_TASKS)))


def write_arc(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages(page_id, url, html) as ARC archives; gives a metadata row for each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, place = TaskContext.get().partitionId(), 0, None, 0
        for batch in slices(batches, "html", 8 << 20):
            rows = []
            for page_id, url, html in zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "html")), strict=True):
                if out is None:
                    version, place = 1 + (part + number) % 2, 0
                    out = Output(folder, f"part-{part:06d}-{number:04d}.arc.gz")
                    out.member(version_block(out.name, version))
                payload = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n" + (f"{ROW}: {page_id}\r\n" if page_id is not None else "")
                out.member(arc_record(header_url(url), head.encode() + b"\r\n" + payload, version, out.name, out.size))
                rows.append((page_id, base32_sha1(payload), out.name, place))
                place += 1
                if out.raw >= archive_bytes:
                    out.close()
                    number, out = number + 1, None
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int32()), strict=True)], names=["page_id", "digest", "archive", "place"])
        if out is not None:
            out.close()

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, digest string, archive string, place int")


def convert(decided: DataFrame, arc_folder: str, warc_folder: str, tasks: int) -> DataFrame:
    """Convert each archive to WARC. decided(archive, place, r_archive, r_place, r_page): the record that a revisit refers to, else nulls. Gives (warc, records)."""

    def one(archive: str, decisions: Iterator[tuple]) -> tuple[str, int]:
        out, n = Output(warc_folder, archive.replace(".arc.gz", ".warc.gz")), 0
        with opened(arc_folder, archive) as stream:
            for k, (record, (place, r_archive, r_place, r_page)) in enumerate(zip(read_arc(stream), decisions, strict=True)):
                if k != place:
                    raise ValueError(f"{archive} has no decision for record {k}")
                head, payload = http_parts(record.body)
                more = {"WARC-IP-Address": record.fields["IP-address"]}
                if ROW in head:
                    more[ROW] = head[ROW]
                block = record.body
                if r_archive is not None:
                    more |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:uuid:{record_id(r_archive, r_place)}>"}
                    if r_page is not None:
                        more[REFERS_ROW] = str(r_page)
                    block = record.body[: len(record.body) - len(payload)]
                out.member(warc_record("response" if r_archive is None else "revisit", record_id(archive, place), record.fields["URL"], record.fields["Archive-date"], base32_sha1(payload), block, more))
                n += 1
        out.close()
        return out.name, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in ("archive", "place", "r_archive", "r_place", "r_page")), strict=True))
        row = next(rows, None)
        while row is not None:
            archive, ahead = row[0], [row]

            def own() -> Iterator[tuple]:
                while ahead[0] is not None and ahead[0][0] == archive:  # noqa: B023
                    yield ahead[0][1:]  # noqa: B023
                    ahead[0] = next(rows, None)  # noqa: B023

            name, n = one(archive, own())
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["warc", "records"])
            row = ahead[0]

    return decided.select("archive", "place", "r_archive", "r_place", "r_page").repartition(tasks, "archive").sortWithinPartitions("archive", "place").mapInArrow(run, "warc string, records long")


def read_back(manifest: DataFrame, warc_folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records of all archives in manifest(warc, records)."""

    def rows(name: str) -> Iterator[tuple]:
        with opened(warc_folder, name) as stream:
            for head, block in read_warc(stream):
                http, payload = http_parts(block)
                digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
                if kind == "response" and digest != base32_sha1(payload):
                    raise ValueError(f"the payload of {head['WARC-Record-ID']} does not match its digest")
                number = lambda k: int(head[k]) if k in head else None  # noqa: B023, E731
                yield number(ROW), len(payload) if kind == "response" else int(http["Content-Length"]), digest, kind, number(REFERS_ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        for name, expected in (r for b in batches for r in zip(b.column("warc").to_pylist(), b.column("records").to_pylist(), strict=True)):
            got, seen = [], 0
            for row in rows(name):
                got.append(row)
                if len(got) == 4096:
                    seen += len(got)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True), kinds, strict=True)], names=names)
                    got = []
            seen += len(got)
            if seen != expected:
                raise ValueError(f"{name} has {seen} records, not {expected}")
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True), kinds, strict=True)], names=names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return manifest.repartition(tasks_of(manifest, manifest.count()), "warc").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Write pages as ARC below folder/arc and convert them to folder/warc; gives the manifest and the metadata rows."""
    arc, warc = f"{folder}/arc", f"{folder}/warc"
    made = cut(write_arc(pages, arc, archive_bytes))
    last = F.lit(2**63 - 1)
    firsts = made.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct(F.coalesce("page_id", last).alias("p"), "archive", "place", "page_id")).alias("r")).where("n > 1")
    firsts = cut(firsts.select("digest", F.col("r.archive").alias("r_archive"), F.col("r.place").alias("r_place"), F.col("r.page_id").alias("r_page")))
    again = (F.col("r_archive") != F.col("archive")) | (F.col("r_place") != F.col("place"))
    decided = made.join(firsts, "digest", "left").select("archive", "place", *(F.when(again, F.col(c)).alias(c) for c in ("r_archive", "r_place", "r_page")))
    archives = made.select("archive").distinct().count()
    return cut(convert(decided, arc, warc, tasks_of(made, archives))), made


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    atexit.register(remove, spark, folder)
    manifest, _ = archive_pages(spread(table(spark, sf_dir, "pages").select("page_id", "url", "html")), folder)
    return read_back(manifest, f"{folder}/warc")


#: DuckDB SQL for the query; base32 is read off the digest's bits, five at a time.
OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h FROM p),
b AS (SELECT h, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda j: CAST(substr(CAST(CAST(unhex(h) AS BIT) AS VARCHAR), 5 * i + j + 1, 1) AS INTEGER) * CAST(pow(2, 4 - j) AS INTEGER)))::INTEGER, 1)), '') AS b32 FROM (SELECT DISTINCT h FROM d)),
f AS (SELECT h, min(page_id) AS first FROM d GROUP BY h)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, b32 AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (h) JOIN b USING (h)
"""
