"""Legacy archive converter: ARC files to WARC files, and reading both.

Archives are text files of bytes that Spark writes and reads itself (whole
file compression), so they may lie in any store.  A compressed file is read
by one task in order; records are cut by their declared lengths only, never by
what a payload happens to contain.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from ..session import scratch_path

#: Field names of the URL record line by version (fixed values of the format).
ARC_FIELDS = {
    "1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    "2": ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
ARC_SCHEMA = "version string, url string, ip string, date string, content_type string, result_code string, location string, payload binary"
_SPACE = re.compile(rb"[\x00-\x20]+")
DIGEST_PREFIX = "sha1:"


def arc_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def arc_record(version: str, url: str, ip: str, date: str, content_type: str, payload: bytes, result_code: str = "200",
               location: str = "-", filename: str = "-") -> bytes:
    """A URL record: header line, payload, line feed.  White space in a field
    would break the line and is percent-encoded."""
    f = [_SPACE.sub(lambda m: b"".join(b"%%%02X" % c for c in m[0]), x.encode("utf-8", "replace")) or b"-" for x in (url, ip, date, content_type)]
    if version == "2":
        f += [result_code.encode(), arc_digest(payload).encode(), location.encode() or b"-", b"0", filename.encode() or b"-"]
    return b" ".join(f) + b" %d\n" % len(payload) + payload + b"\n"


def arc_version_block(version: str, filename: str, date: str) -> bytes:
    """The first record of a file: it names the version and its fields."""
    body = f"{version} 0 cohortkit\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    if version == "1":
        line = f"filedesc://{filename} 0.0.0.0 {date} text/plain {len(body)}\n"
    else:
        line = f"filedesc://{filename} 0.0.0.0 {date} text/plain 200 - - 0 {filename} {len(body)}\n"
    return line.encode() + body + b"\n"


class ArcParser:
    """Feeds on the lines of an archive (without their line feeds) and
    yields parsed records.  The version block at the start gives the field names;
    a file without one is read as version 1."""

    def __init__(self):
        self.version, self.fields = "1", ARC_FIELDS["1"]
        self.head: dict | None = None
        self.parts: list[bytes] = []
        self.need = self.have = 0

    def line(self, data: bytes):
        """The record that this line completes, or None."""
        if self.head is None:
            if not data.strip():
                return None                               # separators between records
            got = data.split(b" ")
            names = self.fields
            if data.startswith(b"filedesc://"):           # its own line tells the version: 5 or 10 fields
                names = ARC_FIELDS["2" if len(got) >= len(ARC_FIELDS["2"]) else "1"]
            if len(got) < len(names) or not got[-1].isdigit():
                raise ValueError(f"not an archive record line: {data[:200]!r}")
            extra = len(got) - len(names)                 # spaces inside the URL
            got = [b" ".join(got[:extra + 1])] + got[extra + 1:]
            self.head = dict(zip(names, (x.decode("utf-8", "replace") for x in got)))
            self.need, self.have, self.parts = int(got[-1]), 0, []
            return self._done() if self.need == 0 else None
        room = self.need - self.have
        piece = data + b"\n"
        self.parts.append(piece[:room])
        self.have += min(room, len(piece))
        return self._done() if self.have >= self.need else None

    def _done(self):
        head, payload = self.head, b"".join(self.parts)
        self.head, self.parts = None, []
        if head["URL"].startswith("filedesc://"):
            lines = payload.decode("utf-8", "replace").split("\n")
            self.version = lines[0].split(" ")[0]
            if len(lines) > 1 and lines[1].strip():
                self.fields = lines[1].split(" ")
            return None
        return (self.version, head["URL"], head.get("IP-address", "-"), head.get("Archive-date", ""), head.get("Content-type", ""),
                head.get("Result-code"), head.get("Location"), payload)

    def end(self) -> None:
        if self.head is not None:
            raise ValueError(f"archive ends in the middle of a record: {self.head}")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives in a folder (compressed files): version, url,
    ip, date, content_type, result_code, location, payload."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list] = [[] for _ in range(8)]
        file, parser, held = None, ArcParser(), 0
        names = [f.split()[0] for f in ARC_SCHEMA.split(", ")]
        types = [pa.string()] * 7 + [pa.binary()]
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name != file:
                    parser.end()
                    file, parser = name, ArcParser()
                got = parser.line(data)
                if got:
                    for c, v in zip(cols, got):
                        c.append(v)
                    held += len(got[-1])
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
                cols, held = [[] for _ in range(8)], 0
        parser.end()
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return lines.mapInArrow(run, ARC_SCHEMA)


def write_arc(records: DataFrame, path: str, version: str = "1", file_rows: int = 20000) -> None:
    """Write rows (url, ip, date, content_type, payload) as archives: each
    file is a version block and its records.  Null fields become "-", a null
    payload is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, fresh = 0, True
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out = []
                for url, ip, date, kind, payload in zip(*(part.column(i).to_pylist() for i in range(5))):
                    data = arc_record(version, url or "-", ip or "-", date or "-", kind or "-", payload or b"")
                    if rows % file_rows == 0:             # the writer starts a new file after file_rows rows
                        data = arc_version_block(version, "pages.arc", date or "-") + data
                    rows += 1
                    out.append(data)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    blobs = records.select("url", "ip", "date", "content_type", F.col("payload").cast("binary").alias("payload")).mapInArrow(run, "value binary")
    # records end with their own line feed; no separator is added
    blobs.select(F.expr("cast(substring(value, 1, length(value) - 1) as string)").alias("value")).write.option("lineSep", "\n").option(
        "maxRecordsPerFile", file_rows).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def warc_id(url: str, date: str, digest: str) -> str:
    """The same record gets the same identifier in every conversion."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join((url, date, digest)))}>"


def warc_date(date: str) -> str:
    """W3C timestamp of a 14-digit archive date (shorter ones: the rest as at
    the start of the year; none: the epoch)."""
    digits = re.sub(r"\D", "", date or "")[:14]
    try:
        full = digits + "00000101000000"[len(digits):] if len(digits) >= 4 else "19700101000000"
        return datetime.datetime.strptime(full, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


WARC_FROM_ARC = "url string, ip string, date string, content_type string, payload binary, digest string, record_id string"


def arc_to_warc(records: DataFrame) -> DataFrame:
    """Parsed ARC records with what WARC asks for: W3C date, payload digest
    (bare base32 SHA-1) and a record identifier made from URL, date and digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            url, date, payload = b.column(0).to_pylist(), [warc_date(x) for x in b.column(2).to_pylist()], b.column(4).to_pylist()
            digest = [arc_digest(p or b"") for p in payload]
            ids = [warc_id(u or "", d, g) for u, d, g in zip(url, date, digest)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(date), b.column(3), b.column(4), pa.array(digest), pa.array(ids)],
                                             [f.split()[0] for f in WARC_FROM_ARC.split(", ")])
    return records.select("url", "ip", "date", "content_type", "payload").mapInArrow(run, WARC_FROM_ARC)


def warc_record(kind: str, record_id: str, url: str, ip: str, date: str, content_type: str, digest: str, payload: bytes,
                refers_to: str | None = None, extra: list[tuple[str, str]] = ()) -> bytes:
    """A WARC/1.0 record without its last two line ends."""
    clean = lambda s: re.sub(r"[\r\n]+", " ", s or "")
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", clean(url)),
            ("WARC-IP-Address", clean(ip)), ("WARC-Payload-Digest", DIGEST_PREFIX + digest)]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"), ("WARC-Refers-To", refers_to)]
        payload = b""
    head += [*extra, ("Content-Type", clean(content_type)), ("Content-Length", str(len(payload)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "replace") + b"\r\n" + payload


def write_warc(records: DataFrame, path: str, file_rows: int = 20000) -> None:
    """Write rows (kind, record_id, url, ip, date, content_type, digest,
    payload, refers_to, payload_bytes) as WARC files, one gzip stream a file."""
    names = ["kind", "record_id", "url", "ip", "date", "content_type", "digest", "payload", "refers_to", "payload_bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out = [warc_record(*r[:7], r[7] or b"", r[8], [("X-Full-Payload-Bytes", str(r[9]))])
                       for r in zip(*(part.column(i).to_pylist() for i in range(10)))]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    records.select(*names).mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write.option(
        "lineSep", "\r\n\r\n").option("maxRecordsPerFile", file_rows).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


WARC_SCHEMA = ("record_type string, record_id string, date string, url string, payload_digest string, refers_to string, "
               "content_type string, full_payload_bytes long, payload binary")


class WarcParser:
    """Feeds on the line-feed-separated lines of a WARC file."""

    def __init__(self):
        self.head: dict | None = None
        self.body = False
        self.parts: list[bytes] = []
        self.need = self.have = 0

    def line(self, data: bytes):
        if self.head is None:
            if not data.strip():
                return None
            if not data.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {data[:200]!r}")
            self.head, self.body = {}, False
            return None
        if not self.body:
            text = data.rstrip(b"\r")
            if text:
                k, _, v = text.decode("utf-8", "replace").partition(":")
                self.head[k.strip().lower()] = v.strip()
                return None
            self.body, self.need, self.have, self.parts = True, int(self.head["content-length"]), 0, []
            return self._done() if self.need == 0 else None
        room = self.need - self.have
        piece = data + b"\n"
        self.parts.append(piece[:room])
        self.have += min(room, len(piece))
        return self._done() if self.have >= self.need else None

    def _done(self):
        h, payload = self.head, b"".join(self.parts)
        self.head, self.parts = None, []
        full = h.get("x-full-payload-bytes")
        return (h.get("warc-type"), h.get("warc-record-id"), h.get("warc-date"), h.get("warc-target-uri"),
                (h.get("warc-payload-digest") or "").removeprefix(DIGEST_PREFIX), h.get("warc-refers-to"), h.get("content-type"),
                int(full) if full else len(payload), payload)

    def end(self) -> None:
        if self.head is not None:
            raise ValueError(f"archive ends in the middle of a record: {self.head}")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all WARC files in a folder (compressed files)."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in WARC_SCHEMA.split(", ")]
        types = [pa.string()] * 7 + [pa.int64(), pa.binary()]
        cols: list[list] = [[] for _ in names]
        file, parser, held = None, WarcParser(), 0
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name != file:
                    parser.end()
                    file, parser = name, WarcParser()
                got = parser.line(data)
                if got:
                    for c, v in zip(cols, got):
                        c.append(v)
                    held += len(got[-1]) + 200
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
                cols, held = [[] for _ in names], 0
        parser.end()
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return lines.mapInArrow(run, WARC_SCHEMA)


def convert(spark: SparkSession, arc_path: str, warc_path: str, order: Column | None = None, min_bytes: int = 0) -> None:
    """Convert a folder of ARC files into WARC files.  Of records with equal
    payloads of ``min_bytes`` or more the one with the largest ``order``
    (a column of url, date and digest; by default date, then URL) is written as response,
    the others as revisits that refer to it; smaller ones are all responses.
    Repeated records (equal URL, date and payload) share one identifier and are written alike."""
    rec = arc_to_warc(read_arc(spark, arc_path))
    rank = F.struct("date", "url") if order is None else order
    rec = rec.withColumn("payload_bytes", F.length("payload").cast("long")).withColumn("rank", rank)
    win = (rec.where(F.col("payload_bytes") >= min_bytes).groupBy("digest")
           .agg(F.count("*").alias("copies"), F.max_by("record_id", F.struct("rank", "record_id")).alias("first_id")).where("copies > 1"))
    # only payloads that occur more than once are looked up
    win = stored(win.select(F.col("digest").alias("win_digest"), "first_id"), "warc-responses")
    j = rec.join(win, (F.col("digest") == F.col("win_digest")) & (F.col("payload_bytes") >= min_bytes), "left")
    again = F.col("first_id").isNotNull() & (F.col("record_id") != F.col("first_id"))
    write_warc(j.select(F.when(again, "revisit").otherwise("response").alias("kind"), "record_id", "url", "ip", "date", "content_type",
                        "digest", F.when(~again, F.col("payload")).alias("payload"), F.when(again, F.col("first_id")).alias("refers_to"),
                        "payload_bytes"), warc_path)


def pages_roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
                    arc_version: str = "1") -> DataFrame:
    """Archive a table of pages, convert the archives, read them back.

    The page id travels in the archived URL's fragment and is what decides
    which of equal payloads is the response (the largest).  A null html is an
    empty payload, a null url "-".  Rows without id are read back with a null
    id and are responses only where no row with one has their payload; repeated rows are
    responses or revisits alike.  An empty table gives an empty result.
    Returns page_id, payload_bytes, payload_digest, record_type, refers_to
    (page id of the response for revisits), url."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    pid = F.col(id_col).cast("long")
    write_arc(pages.select(F.concat(F.coalesce(F.col(url_col), F.lit("-")), F.lit("#page="), F.coalesce(pid.cast("string"), F.lit(""))).alias("url"),
                           F.lit("0.0.0.0").alias("ip"), F.lit("20240101000000").alias("date"), F.lit("text/html").alias("content_type"),
                           F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload")), arc, arc_version)

    def page(c):
        return F.regexp_extract(c, r"#page=(-?\d*)$", 1).try_cast("long")

    convert(spark, arc, warc, order=page(F.col("url")), min_bytes=min_bytes)
    back = read_warc(spark, warc)
    narrow = stored(back.select(page(F.col("url")).alias("page_id"), F.col("full_payload_bytes").alias("payload_bytes"), "payload_digest",
                                "record_type", "record_id", F.col("refers_to").alias("refers_id"),
                                F.regexp_replace("url", r"#page=-?\d*$", "").alias("url")), "warc-read")
    target = narrow.where("record_type = 'response'").groupBy(F.col("record_id").alias("to_id")).agg(F.max("page_id").alias("refers_to"))
    return narrow.join(target, F.col("refers_id") == F.col("to_id"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
