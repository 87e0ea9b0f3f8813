"""WARC archives as a table of chunks: written and read without a whole record in memory.

A payload is a sequence of chunks of at most ``chunk`` bytes, numbered within
its record. Every chunk is a WARC record of its own: the first is the
response, the others are its continuations (WARC segmentation), each with its
number and the digest of the payload up to its end, so a reader holds one
chunk and one running digest whatever the payload's length. A payload that an
earlier page has too is a revisit without a block of its own.

Archives are gzip files of records, written by Spark's text writer: every row
is one record's bytes and the line separator is the blank line that ends a
record. A file is read in order by one task. The reader puts the separators
back and follows Content-Length, so separators inside payloads do not matter.

Records of equal payloads (by length, SHA-1 and BLAKE2b) have one response:
that of the smallest page_id, the others revisit it. Rows that repeat that
page_id with that payload are responses as well; a null page_id comes after
all others, and payloads of pages without ids are all responses. A null html
is an empty payload, a null url is left out, and extra columns are ignored.
An empty table gives archives without records. A damaged archive is an error.
"""

from __future__ import annotations

import hashlib
import uuid
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pawprint.llm.common import join_back, need, offsets_of, slices, stored

#: Bytes of payload a chunk; payloads from this length on may be revisits.
CHUNK = 1 << 20
MIN_REVISIT = 0
#: The date of all records: an archive depends on its pages alone.
DATE = "2000-01-01T00:00:00Z"
BATCH_BYTES = 4 << 20

#: Fixed values of the format.
SEP = "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SEP = SEP.encode()


def digests(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The page_id, url and html of every page with payload_bytes, sha1 and check, its
    payload's digests, taken chunk by chunk."""
    plain = need(pages, "page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            offs, data = offsets_of(batch.column("html"))
            sizes, sha, check = [], [], []
            for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
                one, two = hashlib.sha1(), hashlib.blake2b(digest_size=16)
                for at in range(a, b, chunk):
                    part = data[at:min(at + chunk, b)]
                    one.update(part)
                    two.update(part)
                sizes.append(b - a)
                sha.append(one.digest())
                check.append(two.digest())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "url", "html")), pa.array(sizes, pa.int64()),
                 pa.array(sha, pa.binary()), pa.array(check, pa.binary())],
                names=["page_id", "url", "html", "payload_bytes", "sha1", "check"])
    more = [T.StructField("payload_bytes", T.LongType()), T.StructField("sha1", T.BinaryType()),
            T.StructField("check", T.BinaryType())]
    return plain.mapInArrow(run, T.StructType(plain.schema.fields + more))


def with_types(pages: DataFrame, min_revisit: int = MIN_REVISIT, chunk: int = CHUNK) -> DataFrame:
    """``digests`` with record_type and refers_to (the response's page_id)."""
    known = digests(pages, chunk)
    key = ["payload_bytes", "sha1", "check"]
    copied = stored(known.groupBy(*key)
                    .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
                    .filter((F.col("copies") > 1) & (F.col("payload_bytes") >= min_revisit)),
                    "warc-copied")
    joined = join_back(known, copied, key, "copies", "left")
    again = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "sha1",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"))


def _base32(digest: bytes) -> str:
    return b32encode(digest).decode()


def _record_id(page, sha: bytes) -> str:
    """The id of a page's record: the same for the record and those that refer to it."""
    raw = hashlib.blake2b(f"{page}\n".encode() + sha, digest_size=16).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=raw, version=5)}>"


def _record(fields: dict, block: bytes) -> bytes:
    """One record's bytes but for the blank line that ends it."""
    fields["WARC-Block-Digest"] = "sha1:" + _base32(hashlib.sha1(block).digest())
    fields["Content-Length"] = len(block)
    head = "".join([f"{k}: {v}\r\n" for k, v in fields.items() if v is not None])
    return f"{VERSION}\r\n{head}\r\n".encode() + block


def _records(row: dict, data, start: int, end: int, chunk: int) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    def page(value):
        return None if value is None else quote(str(value))
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {end - start}{SEP}").encode()
    name = _record_id(row["page_id"], row["sha1"])
    fields = {
        "WARC-Type": row["record_type"], "WARC-Record-ID": name, "WARC-Date": DATE,
        "WARC-Target-URI": row["url"] and quote(row["url"], safe=":/?#[]@!$&'()*+,;=%~"),
        "WARC-Payload-Digest": "sha1:" + _base32(row["sha1"]),
        "Page-Id": page(row["page_id"]), "Content-Type": "application/http; msgtype=response"}
    if row["record_type"] == "revisit":
        fields |= {"WARC-Profile": PROFILE, "Refers-To-Page-Id": page(row["refers_to"]),
                   "WARC-Refers-To": _record_id(row["refers_to"], row["sha1"])}
        yield _record(fields, http)
        return
    running, number = hashlib.sha1(), 0
    for at in range(start, max(end, start + 1), chunk):
        part = data[at:min(at + chunk, end)].tobytes()
        running.update(part)
        number += 1
        if number > 1:
            raw = hashlib.blake2b(f"{name}{number}".encode(), digest_size=16).digest()
            fields = {"WARC-Type": "continuation", "WARC-Date": DATE,
                      "WARC-Record-ID": f"<urn:uuid:{uuid.UUID(bytes=raw, version=5)}>",
                      "WARC-Segment-Origin-ID": name}
        if end - start > chunk:
            fields |= {"WARC-Segment-Number": number,
                       "Running-Payload-Digest": "sha1:" + _base32(running.digest())}
            if at + chunk >= end:
                fields["WARC-Segment-Total-Length"] = len(http) + end - start
        yield _record(fields, http + part if number == 1 else part)


def _written(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
        for batch in slices(batches, "html"):
            offs, data = offsets_of(batch.column("html"))
            rows = batch.select([c for c in batch.schema.names if c != "html"]).to_pylist()
            for row, a, b in zip(rows, offs[:-1].tolist(), offs[1:].tolist()):
                for record in _records(row, data, a, b, chunk):
                    held.append(record)
                    size += len(record)
                    if size >= BATCH_BYTES:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()
    return run


def write(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, chunk: int = CHUNK) -> None:
    """Archives of all pages below ``path``, one gzip file a task."""
    typed = with_types(pages, min_revisit, chunk)
    (typed.mapInArrow(_written(chunk), "value binary")
     .select(F.col("value").cast("string"))
     .write.option("lineSep", SEP).option("compression", "gzip").option("maxRecordsPerFile", 0)
     .text(path))


class Reader:
    """One archive's records, fed piece by piece.

    States: the head of a record, the HTTP head in its block, payload, and
    the blank line at its end. Held are one head, one chunk and one digest.
    """

    def __init__(self, file: str, payload: bool):
        self.file, self.keep = file, payload
        self.buffer = bytearray()
        self.state = "head"
        self.page: dict | None = None
        self.fields: dict = {}

    def fail(self, why: str):
        raise ValueError(f"damaged archive {self.file}: {why}")

    def _until_blank(self) -> str | None:
        at = self.buffer.find(_SEP)
        if at < 0:
            return None
        text = self.buffer[:at].decode()
        del self.buffer[:at + len(_SEP)]
        return text

    @staticmethod
    def _fields(text: str) -> tuple[str, dict]:
        first, *lines = text.split("\r\n")
        return first, dict(line.split(": ", 1) for line in lines)

    def feed(self, data: bytes) -> Iterator[dict]:
        self.buffer += data
        while True:
            if self.state == "head":
                text = self._until_blank()
                if text is None:
                    return
                self._open(text)
            if self.state == "http":
                size = len(self.buffer)
                text = self._until_blank()
                if text is None:
                    return
                raw = text.encode() + _SEP
                self.left -= size - len(self.buffer)
                self.block.update(raw)
                self.http_bytes = len(raw)
                self.page["payload_bytes"] = int(self._fields(text)[1]["Content-Length"])
                self.state = "payload"
            if self.state == "payload":
                part = bytes(self.buffer[:self.left])
                del self.buffer[:len(part)]
                self.left -= len(part)
                self.block.update(part)
                self.running.update(part)
                self.read += len(part)
                if self.keep:
                    self.parts.append(part)
                if self.left:
                    return
                self.state = "tail"
            if self.state == "tail":
                if len(self.buffer) < len(_SEP):
                    return
                if self.buffer[:len(_SEP)] != _SEP:
                    self.fail("no blank line after a record")
                del self.buffer[:len(_SEP)]
                self.state = "head"
                yield self._close()

    def _open(self, text: str) -> None:
        version, self.fields = self._fields(text)
        if version != VERSION:
            self.fail(f"{version[:40]!r} where a record should begin")
        self.left = int(self.fields["Content-Length"])
        self.block, self.parts = hashlib.sha1(), []
        if self.fields["WARC-Type"] == "continuation":
            if not self.page or self.fields["WARC-Segment-Origin-ID"] != self.page["record_id"] \
                    or int(self.fields["WARC-Segment-Number"]) != self.page["chunk"] + 2:
                self.fail("a continuation out of its order")
            self.page["chunk"] += 1
            self.state = "payload"
            return
        if self.page:
            self.fail("a record ends too early")
        self.running, self.read = hashlib.sha1(), 0
        self.page = {"record_id": self.fields["WARC-Record-ID"], "chunk": 0,
                     "record_type": self.fields["WARC-Type"], "url": None,
                     "payload_digest": self.fields["WARC-Payload-Digest"].removeprefix("sha1:")}
        for name, field in (("page_id", "Page-Id"), ("refers_to", "Refers-To-Page-Id")):
            self.page[name] = unquote(self.fields[field]) if field in self.fields else None
        self.page["url"] = self.fields.get("WARC-Target-URI")
        self.state = "http"

    def _close(self) -> dict:
        digest = "sha1:" + _base32(self.block.digest())
        if digest != self.fields["WARC-Block-Digest"]:
            self.fail(f"block digest of {self.fields['WARC-Record-ID']}")
        running = _base32(self.running.digest())
        if self.fields.get("Running-Payload-Digest", "sha1:" + running) != "sha1:" + running:
            self.fail(f"running digest of {self.fields['WARC-Record-ID']}")
        response = self.page["record_type"] == "response"
        last = "WARC-Segment-Number" not in self.fields or \
            "WARC-Segment-Total-Length" in self.fields
        if last and response and (self.read != self.page["payload_bytes"]
                                  or running != self.page["payload_digest"]):
            self.fail(f"payload of {self.page['record_id']}")
        row = self.page | {"last": last, "payload": b"".join(self.parts) if self.keep else None,
                           "running_digest": running if response else None}
        if last:
            self.page = None
        return row

    def end(self) -> Iterator[dict]:
        yield from self.feed(_SEP)
        if self.state != "head" or self.page or bytes(self.buffer) not in (b"", _SEP):
            self.fail("it ends inside a record")


CHUNKS = pa.schema([
    ("record_id", pa.string()), ("chunk", pa.int32()), ("last", pa.bool_()),
    ("record_type", pa.string()), ("page_id", pa.string()), ("refers_to", pa.string()),
    ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("running_digest", pa.string()), ("payload", pa.binary())])
CHUNKS_DDL = ("record_id string, chunk int, last boolean, record_type string, page_id string, "
              "refers_to string, url string, payload_bytes bigint, payload_digest string, "
              "running_digest string, payload binary")


def _parsed(payload: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        reader = None
        for batch in batches:
            files = batch.column("file").dictionary_encode()
            for value, at in zip(batch.column("value"), files.indices.to_pylist()):
                name, value = files.dictionary[at].as_py(), value.as_py()
                if reader is None or reader.file != name:
                    if reader is not None:
                        yield from reader.end()
                    reader = Reader(name, payload)
                else:
                    value = _SEP + value
                yield from reader.feed(value)
        if reader is not None:
            yield from reader.end()

    def run(batches):
        held, size = [], 0
        for row in rows(batches):
            held.append(row)
            size += len(row["payload"] or b"") + 400
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(held, CHUNKS)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, CHUNKS)
    return run


def read_chunks(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row a chunk: (record_id, chunk, last, record_type, page_id, refers_to, url,
    payload_bytes, payload_digest, running_digest, payload), all digests checked."""
    lines = spark.read.option("lineSep", SEP).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"),
                        F.col("value").cast("binary")).mapInArrow(_parsed(payload), CHUNKS_DDL)


def read(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, chunks) of every record."""
    return read_chunks(spark, path, payload=False).filter("last").select(
        F.col("page_id").cast(id_type), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(id_type), (F.col("chunk") + 1).alias("chunks"))


def _base32_sql(digest: str) -> str:
    """A hexadecimal digest of 40 digits in base 32: four characters for every five digits."""
    part = "('0x' || substr({d}, {at}, 5))::BIGINT"
    return " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
        f"((({part.format(d=digest, at=5 * g + 1)}) >> {s}) & 31)::INTEGER + 1, 1)"
        for g in range(8) for s in (15, 10, 5, 0))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_base32_sql('h')} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM h
"""
