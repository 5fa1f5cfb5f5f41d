"""WARC archives: writing captures, reading records, and joining a capture's records into one nested row.

Every capture is written as a response (or, for a payload written elsewhere, a revisit) with a request and a metadata
record that name it in ``WARC-Concurrent-To``. Spark's text sink writes the archives: a row is an archive, bounded by bytes,
and the two line ends that close its last record are the sink's line separator.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "\r\n\r\n"
#: An archive is closed when its records have so many bytes, so that a task can hold one.
ARCHIVE_BYTES = 32 << 20
#: Shares into which the revisits of one response are dealt.
SHARES = 256
_MAP = T.MapType(T.StringType(), T.StringType())

RECORD = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("concurrent_to", T.ArrayType(T.StringType())),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("start_line", T.StringType()),
        T.StructField("fields", _MAP),
        T.StructField("payload", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
    ]
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(text: object) -> str:
    """A header value on one line."""
    return str(text).replace("\r", "%0D").replace("\n", "%0A")


def _record(kind: str, record_id: str, date: str, content_type: str, block: bytes, **named: object) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("Content-Type", content_type)]
    head += [("WARC-" + k.replace("_", "-"), v) for k, v in named.items() if v is not None]
    head.append(("Content-Length", len(block)))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {_line(v)}\r\n" for k, v in head) + "\r\n").encode() + block


def response_id(key: object, digest: str) -> str:
    """The record id of the response to a capture: the same wherever it is computed."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{digest}')}>"


def write_warc(
    captures: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_revisit_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write every row of ``captures`` as one transaction to gzipped archives below ``path``. An archive begins with a
    warcinfo record and ends with the capture that brings it to ``archive_bytes`` before compression.

    The payload is the text in UTF-8, empty for NULL. Of rows with equal payloads of at least ``least_revisit_bytes`` the
    one with the largest key is a response, all with a smaller (or NULL) key revisit it; rows that tie on the largest key
    are all responses, as are all rows of a group without any key. Repeated rows are written each; a NULL address is left
    out; other columns are ignored. Line ends inside an address are percent-encoded.

    Groups are found by digest with partial aggregation; the one row per digest that is joined back lets Spark split a
    digest that a third of all rows share.
    """
    rows = captures.select(
        captures[key].alias("key"), captures[url].alias("url"), F.coalesce(captures[payload].cast("binary"), F.lit(b"")).alias("payload")
    )
    rows = rows.withColumn("sha1", F.sha1("payload"))
    originals = rows.groupBy("sha1").agg(F.max("key").alias("original"))
    rows = rows.join(originals, "sha1").select("key", "url", "payload", "original")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def archive() -> pa.RecordBatch:
            info = _record("warcinfo", f"<urn:uuid:{uuid.uuid4()}>", date, "application/warc-fields", b"format: WARC File Format 1.1\r\n")
            return pa.RecordBatch.from_arrays([pa.array([END.encode().join((info, *held))], pa.binary())], ["value"])

        for batch in batches:
            for k, address, body, original in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digest = base32_sha1(body)
                same_id, revisit = response_id(k, digest), original is not None and k != original and len(body) >= least_revisit_bytes
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                named = {"Target_URI": address, "Payload_Digest": f"sha1:{digest}"}
                if revisit:
                    named |= {"Refers_To": response_id(original, digest), "Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
                http = "application/http; msgtype="
                main = _record("revisit" if revisit else "response", same_id, date, http + "response", head if revisit else head + body, **named)
                host, _, rest = _line(address or "").partition("://")[2].partition("/")
                ask = f"GET /{rest} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
                request = _record("request", f"<urn:uuid:{uuid.uuid4()}>", date, http + "request", ask, Target_URI=address, Concurrent_To=same_id)
                notes = "" if k is None else f"key: {_line(k)}\r\n"
                about = _record("metadata", f"<urn:uuid:{uuid.uuid4()}>", date, "application/warc-fields", notes.encode(), Target_URI=address, Concurrent_To=same_id)
                held += (main, request, about)
                size += len(main) + len(request) + len(about)
                if size >= archive_bytes:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    lines = rows.mapInArrow(records, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


class _Stream:
    """Bytes of an archive, plain or gzipped (in one member or many), inflated as they are read."""

    def __init__(self, content: bytes):
        self.rest, self.held, self.at = content, bytearray(), 0
        self.gzip = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None
        if self.gzip is None:
            self.held, self.rest = content, b""

    def more(self) -> bool:
        """Inflate another stretch; False at the end."""
        while self.gzip is not None and self.rest:
            got = self.gzip.decompress(self.rest, 1 << 20)
            self.rest = self.gzip.unconsumed_tail or self.gzip.unused_data
            if self.gzip.eof:
                self.rest = self.gzip.unused_data
                self.gzip = zlib.decompressobj(31)
            if got:
                del self.held[: self.at]
                self.at = 0
                self.held += got
                return True
            if not self.rest:
                return False
        return False

    def upto(self, mark: bytes) -> bytes | None:
        """What comes before the next ``mark``, which is passed; None if there is none."""
        seek = self.at
        while (found := self.held.find(mark, seek)) < 0:
            ahead = max(len(self.held) - len(mark) + 1 - self.at, 0)
            if not self.more():
                return None
            seek = self.at + ahead
        out, self.at = bytes(self.held[self.at : found]), found + len(mark)
        return out

    def take(self, n: int) -> bytes | None:
        while len(self.held) - self.at < n:
            if not self.more():
                return None
        out, self.at = bytes(self.held[self.at : self.at + n]), self.at + n
        return out

    def skip_line_ends(self) -> None:
        while True:
            while self.at < len(self.held) and self.held[self.at] in b"\r\n":
                self.at += 1
            if self.at < len(self.held) or not self.more():
                return


def _headers(lines: list[str]) -> list[tuple[str, str]]:
    pairs = (x.partition(":") for x in lines)
    return [(k.strip().lower(), v.strip()) for k, sep, v in pairs if sep]


def parse_archive(name: str, content: bytes, with_payload: bool = True) -> Iterator[tuple]:
    """The records of one archive, as rows of ``RECORD``. Bytes that aren't a whole record end it with a row of type
    ``malformed``."""
    stream = _Stream(content)
    bad = (name, None, "malformed", [], *[None] * (len(RECORD) - 4))
    while True:
        stream.skip_line_ends()
        if stream.at >= len(stream.held):
            return
        head = stream.upto(END.encode())
        lines = head.decode("utf-8", "replace").split("\r\n") if head is not None else [""]
        pairs = _headers(lines[1:])
        named = dict(pairs)
        size = named.get("content-length", "")
        if not lines[0].startswith("WARC/") or not size.isdecimal() or (block := stream.take(int(size))) is None:
            yield bad
            return
        kind, content_type = named.get("warc-type", ""), named.get("content-type", "")
        start, fields, body = None, [], block
        if content_type.startswith("application/http"):
            http, _, body = block.partition(END.encode())
            start, *rest = http.decode("utf-8", "replace").split("\r\n")
            fields = _headers(rest)
        elif content_type.startswith("application/warc-fields"):
            fields, body = _headers(block.decode("utf-8", "replace").split("\r\n")), b""
        length, digest = len(body), None
        if kind == "revisit":  # the payload is elsewhere; its headers were kept
            stated = dict(fields).get("content-length", "")
            length = int(stated) if stated.isdecimal() else None
            digest = named.get("warc-payload-digest", "").rpartition(":")[2] or None
        elif kind == "response":
            digest = base32_sha1(body)
        concurrent = [v for k, v in pairs if k == "warc-concurrent-to"]
        yield (
            name, named.get("warc-record-id"), kind, concurrent, named.get("warc-refers-to"), named.get("warc-target-uri"), named.get("warc-date"),
            content_type, start, list(dict(fields).items()), body if with_payload and kind == "response" else None, length, digest,
        )


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives below ``path``. An archive is read by one task, so it has to fit there once compressed."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 5, pa.map_(pa.string(), pa.string()), pa.binary(), pa.int64(), pa.string()]

        def rows(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), arrow, strict=True)], RECORD.names)

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held, size = [], 0
                for record in parse_archive(name, content.as_py(), with_payload):
                    held.append(record)
                    size += 500 + len(record[10] or b"")
                    if size > 1 << 23:
                        yield rows(held)
                        held, size = [], 0
                if held:
                    yield rows(held)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, RECORD)


def revisited(captures: DataFrame, key: Column) -> DataFrame:
    """``captures`` with the column ``revisits``: of a revisit the ``key`` of the response whose record id it refers to
    (the largest, where several responses have that id), NULL where there is none; NULL for all other captures.

    Revisits of one response are dealt into ``SHARES`` shares. The response's key goes to the shares that there are, so a
    payload that a third of all captures have comes back in many tasks, and one with a few in as many rows.
    """
    again = F.col("record_type") == "revisit"
    share = F.pmod(F.xxhash64("record_id"), F.lit(SHARES)).cast("int")
    asked = captures.where(again & F.col("refers_to").isNotNull()).select(F.col("refers_to").alias("_asked"), share.alias("_share")).distinct()
    known = captures.where("record_type = 'response'").groupBy(F.col("record_id").alias("_asked")).agg(F.max(key).alias("_key"))
    told = asked.join(known, "_asked")
    # captures that revisit nothing get a key of their own, so that they are spread as well
    rows = captures.withColumns({"_asked": F.coalesce(F.when(again, F.col("refers_to")), "record_id"), "_share": share})
    out = rows.join(told, ["_asked", "_share"], "left")
    return out.select(*captures.columns, F.when(again, F.col("_key")).alias("revisits"))


def assemble_transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its ``request`` and ``metadata``, NULL where missing.

    A request or metadata record belongs to the capture it names in a concurrent-to header, or that names it. Of several
    of a kind the one with the smallest record id counts, so a capture never gives more than one row; captures that share
    a record id each keep their row.
    """
    main = records.where(F.col("record_type").isin("response", "revisit"))
    side = records.where(F.col("record_type").isin("request", "metadata")).select("record_id", "record_type", "concurrent_to", "start_line", "fields")
    named = side.select("record_id", F.explode("concurrent_to").alias("capture_id"), "record_type", "start_line", "fields")
    naming = main.select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("capture_id")).distinct()
    named = named.unionByName(naming.join(side.drop("concurrent_to"), "record_id"))

    def first(kind: str) -> Column:
        entry = F.struct("record_id", "start_line", F.array_sort(F.map_entries("fields")).alias("fields"))
        return F.min(F.when(F.col("record_type") == kind, entry)).alias(kind)

    sides = named.groupBy("capture_id").agg(first("request"), first("metadata"))

    def nested(kind: str) -> Column:
        e = F.col(kind)
        return F.when(e.isNotNull(), F.struct(e["record_id"].alias("record_id"), e["start_line"].alias("start_line"), F.map_from_entries(e["fields"]).alias("fields"))).alias(kind)

    joined = main.join(sides, F.col("record_id") == F.col("capture_id"), "left")
    return joined.select(*(c for c in RECORD.names if c != "concurrent_to"), nested("request"), nested("metadata"))
