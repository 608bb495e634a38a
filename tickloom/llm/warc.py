"""WARC archives of pages, and a two-level capture index.

Archives are WARC 1.1 files of one gzip member per record, written and read by Spark's text source: the line separator
is an empty gzip member, so files are valid .warc.gz content, and Spark splits them between records on any file system.
Of records with equal payloads the one with the largest page_id is a response; the others revisit it, and hold its
digest and length but not its bytes.

The index has one line per capture: URL key with the host reversed, time, and JSON with the record's place. Lines are
sorted, cut into blocks of ``LINES`` and compressed; a sparse directory, sorted too, holds each block's first key and place.
A look-up searches the directory, reads the blocks' byte ranges, bisects their lines, and reads the records' ranges.

Defined cases: null html is an empty payload, and empty payloads are equal to each other; a page without url has an
empty key; one without page_id is a response if no page with the same payload has one; rows that repeat the page_id of
a response are responses; other columns are ignored.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator
import gzip
import hashlib
import json
import re
from urllib.parse import urlsplit
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickloom.llm.store import Workspace, ready

#: An empty gzip member; a fixed value.
SEPARATOR = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
LINES = 3000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _escaped(url: str) -> str:
    """Without blanks and control signs, which end header fields and index fields."""
    return re.sub(r"[\x00-\x20\x7f-\xa0\u2028\u2029]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url)


def url_key(url: str | None) -> str:
    """Host labels from the last, then path and query: ``com,example,m)/en/25?page=2``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url if "//" in url else "//" + url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return _escaped(url.lower())
    host = re.sub(r"^www\d*\.", "", host)
    key = re.sub(r"\s", "", ",".join(reversed(host.split("."))))
    if port and (parts.scheme, port) not in (("http", 80), ("https", 443)):
        key += f":{port}"
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{key}){_escaped(tail.lower())}"


def member(data: bytes) -> bytes:
    """A gzip member without the separator in it."""
    for level in (6, 9, 1, 4):
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        out = packer.compress(data) + packer.flush()
        if SEPARATOR not in out:
            return out
    packer = zlib.compressobj(9, zlib.DEFLATED, 31, 8, zlib.Z_HUFFMAN_ONLY)
    return packer.compress(data) + packer.flush()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response record, or a revisit without its payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}"]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + _escaped(url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Header fields of a record, those of its HTTP message, and the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def _text(source):
    return source.option("lineSep", SEPARATOR.decode("latin-1")).option("encoding", "ISO-8859-1")


def write_members(members: DataFrame, path: str) -> None:
    """The one binary column of ``members`` as files of gzip members."""
    name = members.columns[0]
    _text(members.select(F.col(name).cast("string").alias("value")).write).text(path)


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """value (binary), file and block: the split that it was read in."""
    return _text(spark.read).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


class _Places:
    """Places of members within their splits, as they come by."""

    def __init__(self):
        self.at: dict[tuple[str, int], int] = {}

    def __call__(self, file: str, block: int, value: bytes) -> tuple[int, int]:
        within = self.at.get((file, block), 0)
        self.at[file, block] = within + len(value) + len(SEPARATOR)
        return within, len(value)


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``within`` their split made ``offset`` in their file, by the sizes of the splits before."""
    sizes = rows.groupBy("file", "block").agg(F.sum(F.col("length") + len(SEPARATOR)).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, ["file", "block"]).withColumn("offset", F.col("base") + F.col("within")).drop("block", "within", "base")


def _records(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, payload, digest, refers_to, revisit in zip(*(batch.column(k) for k in range(6))):
                out.append(member(record(
                    page_id.as_py(), url.as_py(), payload.as_py(), base32(digest.as_py()), refers_to.as_py(), revisit.as_py(), date)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return run


def write_archives(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """A record per row of ``pages`` (page_id, url, html); payloads under ``least`` bytes are never revisits."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    first = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("page_id").alias("first"))
    # who revisits whom is told without payloads, so that no digest gathers those of all its copies
    again = rows.where(F.octet_length("payload") >= least).select("page_id", "digest").distinct().join(first, "digest")
    again = again.where(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    again = again.select(F.col("page_id").alias("page"), F.col("digest").alias("same"), "first")
    marked = rows.join(again, F.col("page_id").eqNullSafe(F.col("page")) & (F.col("digest") == F.col("same")), "left").select(
        "page_id", "url", "payload", "digest", "first", F.col("first").isNotNull().alias("revisit"))
    write_members(marked.mapInArrow(_records(date), "value binary"), path)


CAPTURE = (
    "key string, time string, url string, page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, file string, block long, within long, length long")


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places = _Places()
    for batch in batches:
        rows = []
        for value, file, block in zip(*(batch.column(k) for k in range(3))):
            value, file, block = value.as_py(), file.as_py(), block.as_py()
            fields, http, payload = parsed(gzip.decompress(value))
            revisit = fields["WARC-Type"] == "revisit"
            page, url, refers = fields.get("X-Page-ID"), fields.get("WARC-Target-URI"), fields.get("X-Refers-To-Page")
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if not revisit and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                raise ValueError(f"the payload of page {page} in {file} does not have its digest")
            rows.append((
                url_key(url), re.sub(r"\D", "", fields["WARC-Date"]), url, page and int(page),
                int(http["Content-Length"]) if revisit else len(payload), digest, fields["WARC-Type"],
                refers and int(refers), file, block, *places(file, block, value)))
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) or [()] * 12
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in CAPTURE.split(", ")])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: its URL key, fields, payload size and digest, and its split and place there."""
    ready(spark)
    return read_members(spark, path).mapInArrow(_captures, CAPTURE)


_FIELDS = ("url", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset", "length")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[str] = []

    def block() -> pa.RecordBatch:
        out = member(("\n".join(held) + "\n").encode())
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], ["value"])

    for batch in batches:
        for row in batch.to_pylist():
            held.append(f"{row['key']} {row['time']} {json.dumps({k: row[k] for k in _FIELDS})}")
            if len(held) == LINES:
                yield block()
    if held:
        yield block()


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places = _Places()
    for batch in batches:
        rows = []
        for value, file, block in zip(*(batch.column(k) for k in range(3))):
            first = gzip.decompress(value.as_py()).split(b" ", 1)[0].decode()
            rows.append((first, file.as_py(), block.as_py(), *places(file.as_py(), block.as_py(), value.as_py())))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "file", "block", "within", "length"])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for batch in batches:
        for value in batch.column(0):
            rows = [json.loads(line.split(b" ", 2)[2]) for line in gzip.decompress(value.as_py()).splitlines()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)


class CaptureIndex:
    """Sorted, compressed blocks of captures in ``path``/blocks and their directory in ``path``/directory."""

    def __init__(self, spark: SparkSession, path: str):
        ready(spark)
        self.spark, self.path = spark, path

    @classmethod
    def build(cls, spark: SparkSession, archives: str, space: Workspace) -> "CaptureIndex":
        captures = space.save(read_archives(spark, archives), "captures")
        order = ["key", "time", "page_id"]
        lines = placed(captures).repartitionByRange(*order).sortWithinPartitions(*order)
        index = cls(spark, f"{space.path}/index")
        write_members(lines.mapInArrow(_blocks, "value binary"), f"{index.path}/blocks")
        heads = space.save(read_members(spark, f"{index.path}/blocks").mapInArrow(
            _heads, "key string, file string, block long, within long, length long"), "heads")
        placed(heads).repartitionByRange("key").sortWithinPartitions("key").write.parquet(f"{index.path}/directory")
        return index

    def captures(self) -> DataFrame:
        """Every capture, from the blocks."""
        return read_members(self.spark, f"{self.path}/blocks").select("value").mapInArrow(
            _lines, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")

    def _range(self, file: str, offset: int, length: int) -> bytes:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(path)
        try:
            stream.seek(offset)
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
        finally:
            stream.close()

    def lookup(self, url: str) -> list[dict]:
        """The captures of a URL: fields and place.

        Spark searches the directory, whose files hold ranges of keys in order. Only the blocks that can hold the key
        reach the driver, as places, one at a time: those that begin with it, and the last one before them.
        """
        key = url_key(_escaped(url))
        directory = self.spark.read.parquet(f"{self.path}/directory").select("key", "file", "offset", "length")
        before = directory.where(F.col("key") < key).agg(F.max(F.struct(*directory.columns)).alias("block")).where("block is not null")
        may = directory.where(F.col("key") == key).unionByName(before.select("block.*"))
        found = []
        for block in may.orderBy("key", "file", "offset").toLocalIterator():
            lines = gzip.decompress(self._range(block.file, block.offset, block.length)).splitlines()
            at = bisect_left(lines, key.encode(), key=lambda line: line.split(b" ", 1)[0])
            for line in lines[at:]:
                own, time, fields = line.split(b" ", 2)
                if own.decode() != key:
                    break
                found.append({"time": time.decode(), **json.loads(fields)})
        return found

    def payload(self, capture: dict) -> bytes:
        """Bytes of a capture of type response."""
        return parsed(gzip.decompress(self._range(capture["file"], capture["offset"], capture["length"])))[2]


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages``, read the archives back, index them, and return every capture from the index."""
    space = Workspace(pages.sparkSession, "warc")
    write_archives(pages, f"{space.path}/archives")
    return CaptureIndex.build(pages.sparkSession, f"{space.path}/archives", space).captures()
