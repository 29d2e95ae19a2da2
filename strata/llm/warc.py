"""Web archives: a converter from legacy ARC to WARC, and readers and writers of both.

ARC (versions 1 and 2) gives each record one header line, whose fields depend
on the version and whose last field declares the length of what follows.  The
converter reads records by that length, never by what their content looks
like, and synthesises the WARC record: type, identifier, timestamp, digests.

Archives are raw files written by Spark's text sink (gzip) and read as a
stream of lines that are put together again byte by byte, so memory is bounded
by one record, whatever the size of a file, and the paths can be of any store
that Spark reads.  A gzip file is one task.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain, groupby
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Stage, bytes_of, query, table

CRLF = b"\r\n"
# Header fields of an ARC record by format version (fixed by the format).
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
# Profile of a WARC 1.1 revisit whose payload equals an earlier one (fixed by the format).
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DEFAULT_DATE = "20000101000000"
MIN_REVISIT_BYTES = 0
# Deflate level of the archives (Hadoop's name for 4): a third of the default's time for files a few percent larger.
GZIP_LEVEL = "FOUR"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class ArcRecord:
    version: int
    header: dict[str, str]
    content: bytes


@dataclass
class WarcRecord:
    header: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    def to_bytes(self) -> bytes:
        """The record up to, not including, the two line ends that close it."""
        lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in self.header.items())]
        return "\r\n".join(lines).encode() + CRLF + f"Content-Length: {len(self.block)}".encode() + CRLF + CRLF + self.block


# ARC ---------------------------------------------------------------------------------------------

def arc_url(url: str | None) -> str:
    """A url without blanks or control characters (they separate header fields)."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "unknown:"


def arc_version_block(version: int, name: str, date: str = DEFAULT_DATE) -> bytes:
    """The version block that opens an ARC file."""
    fields = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
    body = f"{version} 0 strata\n{fields[version]}\n".encode()
    values = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": date, "mime": "text/plain"}
    return _arc_line(version, values, len(body)) + body


def _arc_line(version: int, values: dict[str, str], length: int) -> bytes:
    got = {"status": "200", "checksum": "-", "location": "-", "offset": "0", "filename": "-"} | values
    return (" ".join(str(length) if f == "length" else got[f] for f in ARC_FIELDS[version]) + "\n").encode()


def arc_record(version: int, url: str | None, content: bytes, ip: str = "0.0.0.0",
               date: str = DEFAULT_DATE, mime: str = "text/html") -> bytes:
    """One ARC record, without the line end that closes it."""
    return _arc_line(version, {"url": arc_url(url), "ip": ip, "date": date, "mime": mime}, len(content)) + content


class _Lines:
    """Bytes of a file that arrive as its lines (without their line ends)."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.rest = lines, b""

    def line(self) -> bytes | None:
        """Up to the next line end, or None at the end of the file."""
        if self.rest:
            head, found, tail = self.rest.partition(b"\n")
            if found:
                self.rest = tail
                return head
            raise ValueError("line end expected")
        return next(self.lines, None)

    def take(self, n: int) -> bytes:
        """The next n bytes."""
        parts, have = [self.rest], len(self.rest)
        while have < n:
            got = next(self.lines, None)
            if got is None:
                raise ValueError(f"archive ends {n - have} bytes short of a declared length")
            parts.append(got)
            parts.append(b"\n")
            have += len(got) + 1
        data = b"".join(parts)
        self.rest = data[n:]
        return data[:n]


def parse_arc(lines: Iterator[bytes]) -> Iterator[ArcRecord]:
    """Records of an ARC file given as its lines; the version block tells the header fields.

    The header is split from the right, as a url of old archives may hold
    blanks.  Blank lines between records are skipped; a header line of the
    wrong number of fields or without a length, or a file that ends inside a
    record, is an error.
    """
    src, version = _Lines(lines), 1
    while (line := src.line()) is not None:
        line = line.rstrip(b"\r")
        if not line:
            continue
        text = line.decode("utf-8", "replace")
        names = ARC_FIELDS[version]
        if text.startswith("filedesc://"):
            names = ARC_FIELDS[2 if len(text.split(" ")) >= len(ARC_FIELDS[2]) else 1]
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not an ARC header line: {text[:200]!r}")
        header = dict(zip(names, values))
        content = src.take(int(header["length"]))
        if header["url"].startswith("filedesc://"):
            version = int(content.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        yield ArcRecord(version, header, content)


# ARC -> WARC ---------------------------------------------------------------------------------------

def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP status line and headers (with the blank line) and payload; no headers: all is payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = re.search(rb"\r?\n\r?\n", content)
    return (content[:end.end()], content[end.end():]) if end else (content, b"")


def warc_date(arc_date: str) -> str:
    """YYYYMMDDhhmmss (or a shorter stem of it) as an ISO timestamp in UTC."""
    digits = (re.sub(r"\D", "", arc_date) + DEFAULT_DATE[len(re.sub(r"\D", "", arc_date)):])[:14]
    try:
        return datetime.datetime.strptime(digits, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return datetime.datetime.strptime(DEFAULT_DATE, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(kind: str, *parts: str) -> str:
    """A WARC-Record-ID that depends on what it names alone, so a repeated task gives the same one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((kind, *parts)))}>"


@dataclass(frozen=True)
class Known:
    """What a pass over a record's content gives: each of its bytes is hashed once."""

    head: bytes            # HTTP headers
    payload_bytes: int
    payload_sha1: str
    record_id: str


def known(arc: ArcRecord, name: str = "") -> Known:
    """The record id names the key, url, date, headers and payload."""
    head, payload = split_http(arc.content)
    digest = payload_digest(payload)
    parts = (name, arc.header["url"], warc_date(arc.header["date"]), payload_digest(head), digest)
    return Known(head, len(payload), digest, record_id("response", *parts))


def convert(arc: ArcRecord, name: str = "", refers_to: str | None = None, has: Known | None = None) -> WarcRecord:
    """The WARC record of an ARC record.

    The version block becomes a warcinfo record, HTTP content a response, and
    other content a resource.  ``refers_to`` (a record id) makes a response a
    revisit, which keeps the HTTP headers but not the payload.  ``has`` is
    what is known of the content.
    """
    url, date = arc.header["url"], warc_date(arc.header["date"])
    if url.startswith("filedesc://"):
        block = f"format: WARC File Format 1.1\r\nconverted-from: ARC/{arc.version} {url[11:]}\r\n".encode()
        return WarcRecord({"WARC-Type": "warcinfo", "WARC-Record-ID": record_id("warcinfo", url, date),
                           "WARC-Date": date, "Content-Type": "application/warc-fields"}, block)
    has = has or known(arc, name)
    head = has.head
    kind = "revisit" if refers_to and head else "response" if head else "resource"
    header = {"WARC-Type": kind, "WARC-Record-ID": has.record_id, "WARC-Date": date, "WARC-Target-URI": url}
    if arc.header["ip"] not in ("", "0.0.0.0"):
        header["WARC-IP-Address"] = arc.header["ip"]
    header["WARC-Payload-Digest"] = "sha1:" + has.payload_sha1
    block = head if kind == "revisit" else arc.content
    header["WARC-Block-Digest"] = "sha1:" + (payload_digest(block) if head else has.payload_sha1)
    if kind == "revisit":
        header |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": refers_to}
    header["Content-Type"] = "application/http;msgtype=response" if head else arc.header["mime"]
    return WarcRecord(header, block)


def parse_warc(lines: Iterator[bytes]) -> Iterator[WarcRecord]:
    """Records of a WARC file given as its lines."""
    src = _Lines(lines)
    while (line := src.line()) is not None:
        if not line.rstrip(b"\r"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        header: dict[str, str] = {}
        while (line := src.line()) is not None and (line := line.rstrip(b"\r")):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            header[k.strip()] = v.strip()
        yield WarcRecord(header, src.take(int(header.pop("Content-Length"))))


# Spark ---------------------------------------------------------------------------------------------

def _by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """(file, its lines) for the files of a task, which come one after the other."""
    def runs() -> Iterator[tuple[str, list[bytes]]]:
        for batch in batches:
            names, values = pc.run_end_encode(batch["file"]), batch["value"].to_pylist()
            begin = 0
            for end, name in zip(names.run_ends.to_pylist(), names.values.to_pylist()):
                yield name, values[begin:end]
                begin = end

    for name, group in groupby(runs(), key=lambda r: r[0]):
        yield name, chain.from_iterable(v for _, v in group)


def read_records(spark: SparkSession, path: str, parse: Callable, row: Callable, schema: str) -> DataFrame:
    """Every record of the gzipped archives under ``path`` as ``row(file, record)`` (None: left out)."""
    lines = spark.read.schema("value string").option("lineSep", "\n").text(path)
    lines = lines.select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for name, group in _by_file(batches):
            for record in parse(group):
                r = row(name, record)
                if r is not None:
                    out.append(r)
                    size += sum(len(v) for v in r.values() if isinstance(v, (bytes, str)))
                if size > 4 << 20 or len(out) > 4096:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    return lines.mapInArrow(run, schema)


def _write(records: DataFrame, path: str, line_sep: str) -> None:
    """Raw bytes of each row, each closed by ``line_sep``, as gzipped files."""
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", line_sep) \
        .option("compression", "gzip").option("zlib.compress.level", GZIP_LEVEL).text(path)


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """One ARC file per task, of version 1 and 2 in turn; one record per row, null html as empty.

    The payload follows HTTP headers that give its length and the row's key
    (absent for a null key).
    """
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
                        bytes_of(html).alias("body"), F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = False
        for batch in batches:
            out, ids, urls, parts = [], batch["id"].to_pylist(), batch["url"].to_pylist(), batch["part"].to_pylist()
            for i, (k, u, part) in enumerate(zip(ids, urls, parts)):
                version = 1 + part % 2
                if not opened:
                    out.append(arc_version_block(version, f"pages-{part:05d}.arc"))
                    opened = True
                body = batch["body"][i].as_py()
                own = "" if k is None else f"X-Page-Id: {k}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(body)}\r\n\r\n"
                out.append(arc_record(version, u, head.encode() + body))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    _write(rows.mapInArrow(run, "record binary"), path, "\n")


def http_field(content: bytes, name: str) -> str | None:
    """A field of the HTTP headers that content begins with."""
    head, _ = split_http(content)
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(.*?)\r?$", head)
    return found[1].decode("utf-8", "replace") if found else None


def _page_id(head: bytes) -> int | None:
    got = http_field(head, "X-Page-Id")
    return int(got) if got else None


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, min_revisit: int = MIN_REVISIT_BYTES) -> None:
    """Convert all ARC files under ``arc_path``.

    Of the records whose payloads are equal (SHA-1 and length) and of at least
    ``min_revisit`` bytes, the one with the smallest page id is the response
    and the others revisit it.  Records without a page id are responses.
    """
    stage = Stage(spark, "warc")

    def name_row(file: str, arc: ArcRecord) -> dict | None:
        if arc.header["url"].startswith("filedesc://"):
            return None
        page = _page_id(arc.content)
        has = known(arc, str(page))
        return {"id": page, "digest": has.payload_sha1, "n": has.payload_bytes, "record_id": has.record_id}

    names = stage.save(read_records(spark, arc_path, parse_arc, name_row,
                                    "id long, digest string, n long, record_id string"), "names")
    names = names.where((F.col("n") >= min_revisit) & F.col("id").isNotNull())
    first = stage.save(names.groupBy("digest", "n").agg(
        F.count("*").alias("copies"), F.min(F.struct("id", "record_id")).alias("first")).where("copies > 1"), "first")
    again = names.join(first.hint("merge"), ["digest", "n"]).where("record_id <> first.record_id") \
        .select("record_id", F.col("first.record_id").alias("refers_to"), F.col("first.id").alias("refers_id"))
    again = stage.save(again.distinct(), "again")

    def content_row(file: str, arc: ArcRecord) -> dict:
        has = known(arc, str(_page_id(arc.content)))
        return {"record_id": has.record_id, "version": arc.version, "header": list(arc.header.values()),
                "content": arc.content, "head": has.head, "digest": has.payload_sha1}

    rows = read_records(spark, arc_path, parse_arc, content_row,
                        "record_id string, version int, header array<string>, content binary, head binary, digest string")
    rows = rows.join(again.hint("merge"), "record_id", "left")

    def to_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                names = ARC_FIELDS[1 if len(r["header"]) == len(ARC_FIELDS[1]) else 2]
                has = Known(r["head"], len(r["content"]) - len(r["head"]), r["digest"], r["record_id"])
                warc = convert(ArcRecord(r["version"], dict(zip(names, r["header"])), r["content"]), "", r["refers_to"], has)
                if r["refers_id"] is not None:
                    warc.header["X-Refers-To-Page-Id"] = str(r["refers_id"])
                out.append(warc.to_bytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    _write(rows.select("record_id", "version", "header", "content", "head", "digest", "refers_to", "refers_id")
           .mapInArrow(to_warc, "record binary"), warc_path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record: record_id, type, uri, date, payload_digest, page_id, payload_bytes, refers_to, refers_to_id, payload."""
    def row(file: str, r: WarcRecord) -> dict:
        head, payload = split_http(r.block)
        kind, h = r.header["WARC-Type"], r.header
        length = http_field(head, "Content-Length") if kind == "revisit" else len(payload)
        back = h.get("X-Refers-To-Page-Id")
        return {"record_id": h["WARC-Record-ID"], "type": kind, "uri": h.get("WARC-Target-URI"), "date": h["WARC-Date"],
                "payload_digest": h.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
                "page_id": _page_id(head), "payload_bytes": int(length), "refers_to": h.get("WARC-Refers-To"),
                "refers_to_id": int(back) if back else None, "payload": None if kind == "revisit" else payload}

    return read_records(spark, path, parse_warc, row,
                        "record_id string, type string, uri string, date string, payload_digest string, page_id long, "
                        "payload_bytes long, refers_to string, refers_to_id long, payload binary")


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                  min_revisit: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write pages as ARC, convert to WARC, and read the archives back (see ``read_warc``).

    Null html is an empty payload, a null url is written as ``unknown:``, and a
    row with a null key is a response of its own.  Rows that repeat key, url
    and html name the same record, and are all responses or all revisits.
    An empty table gives an empty result.
    """
    spark = pages.sparkSession
    stage = Stage(spark, "archive")
    write_arc(pages, stage.path("arc"), key, url, html)
    arc_to_warc(spark, stage.path("arc"), stage.path("warc"), min_revisit)
    stage.drop("arc")
    return read_warc(spark, stage.path("warc"))


@query("op3_warc")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return got.where(F.col("type").isin("response", "revisit")).select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.col("refers_to_id").alias("refers_to"))
