"""WARC archives: writing captures and assembling them again from their records.

A capture is three records: the response (or a revisit, if another page with the same payload
keeps it), the request, and metadata; the latter two carry WARC-Concurrent-To. Archives are
gzip files from Spark's own text writer, whose line separator is the blank line that ends a
record, so a lost task's file never shows. Reading joins the pieces between blank lines again by
Content-Length, and assembly joins the records through their concurrent-to identifiers into one
nested row a capture.

Defined cases: a null html is an empty payload; a null url gives no target URI; control
characters and spaces in a url become %20; rows with the same payload and page_id are all
responses; rows that repeat id, url and payload have the same record ids and stay one capture
each; a null page_id revisits the largest one, and is a response where all are null; an empty
table gives no captures.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm.common import map_in_arrow

BLANK = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A table of repeated payloads up to this many rows (about 100 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_PAYLOADS = 300_000
RECORDS = (
    "record_id string, record_type string, concurrent_to string, target_uri string, refers_to string, date string,"
    " content_type string, payload_digest string, payload_bytes long, page_id long, block binary"
)


def base32_of_hex(digest: Column) -> Column:
    """Base32 (RFC 4648) of a 40-digit hexadecimal digest: five digits are four characters."""
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(kind: str, page_id: Column, url: Column, digest: Column) -> Column:
    """A urn:uuid that depends on what the record is of."""
    h = F.md5(F.concat_ws("\x1f", F.lit(kind), F.coalesce(page_id.cast("string"), F.lit("\x00")), F.coalesce(url, F.lit("\x00")), digest))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _headers(*pairs: tuple[str, Column | str]) -> Column:
    """Header lines; those with a null value are left out."""
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{name}: "), F.lit(v) if isinstance(v, str) else v) for name, v in pairs])


def _record(headers: Column, block: Column) -> Column:
    return F.concat(F.lit("WARC/1.1\r\n"), headers, F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(BLANK), block)


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write each row of pages(page_id, url, html) as the records of one capture."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20\x7F]", "%20").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", base32_of_hex(F.sha1(F.col("payload").cast("binary"))))
    latest = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("keeper"))
    latest = latest.where("n > 1 and keeper is not null").select("digest", "keeper").persist()
    keepers = F.broadcast(latest) if latest.count() <= BROADCAST_PAYLOADS else latest
    rows = rows.join(keepers, "digest", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper.page_id"))
    own = [F.col("page_id"), F.col("url"), F.col("digest")]
    capture = _record_id("capture", *own)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(BLANK)
    )
    main = _record(
        _headers(
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", capture),
            ("WARC-Date", date),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("WARC-Refers-To", F.when(revisit, _record_id("capture", F.col("keeper.page_id"), F.col("keeper.url"), F.col("digest")))),
            ("Content-Type", "application/http; msgtype=response"),
        ),
        F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))),
    )
    request = _record(
        _headers(
            ("WARC-Type", "request"),
            ("WARC-Record-ID", _record_id("request", *own)),
            ("WARC-Concurrent-To", capture),
            ("WARC-Date", date),
            ("WARC-Target-URI", F.col("url")),
            ("Content-Type", "application/http; msgtype=request"),
        ),
        F.concat(F.lit("GET "), F.coalesce(F.col("url"), F.lit("/")), F.lit(" HTTP/1.1" + BLANK)),
    )
    metadata = _record(
        _headers(
            ("WARC-Type", "metadata"),
            ("WARC-Record-ID", _record_id("metadata", *own)),
            ("WARC-Concurrent-To", capture),
            ("WARC-Date", date),
            ("WARC-Target-URI", F.col("url")),
            ("Content-Type", "application/warc-fields"),
        ),
        F.concat_ws("", F.lit("via: gondola"), F.concat(F.lit("\r\npage-id: "), F.col("page_id").cast("string")), F.lit("\r\n")),
    )
    value = F.concat_ws(BLANK, main, request, metadata)
    rows.select(value.alias("value")).write.option("lineSep", BLANK).option("compression", "gzip").text(path)
    latest.unpersist()


def _fields(lines: bytes) -> dict[bytes, bytes]:
    found = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


class _Records:
    """Puts records together from the pieces between blank lines."""

    def __init__(self, with_blocks: bool):
        self.with_blocks, self.head, self.block, self.length = with_blocks, None, [], 0

    def feed(self, piece: bytes) -> list[tuple]:
        """The records that this piece ends."""
        if self.head is None:
            if not piece.strip(b"\r\n"):
                return []
            self.head = _fields(piece.lstrip(b"\r\n"))
            self.length = int(self.head.get(b"content-length", 0))
            self.block, self.got = [], -len(BLANK)
            return [self._record(b"")] if not self.length else []
        self.block.append(piece)
        self.got += len(BLANK) + len(piece)
        if self.got < self.length:
            return []
        joined = BLANK.encode().join(self.block)
        done, rest = self._record(joined[: self.length]), joined[self.length :]
        return [done, *self.feed(rest)]  # a block that ends with a line break takes the next record's head along

    def _record(self, block: bytes) -> tuple:
        head, self.head = self.head, None
        text = lambda name: head[name].decode() if name in head else None
        kind = text(b"warc-type")
        digest, size, page = text(b"warc-payload-digest"), None, None
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(BLANK.encode())
            if kind == "response":
                size, computed = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if digest and digest != f"sha1:{computed}":
                    raise ValueError(f"payload of {text(b'warc-record-id')} doesn't have its digest")
                digest = computed
            else:
                size = int(_fields(http).get(b"content-length", 0))
            digest = digest.removeprefix("sha1:") if digest else None
        elif kind == "metadata":
            own = _fields(block)
            page = int(own[b"page-id"]) if b"page-id" in own else None
        kept = block if self.with_blocks else None
        return (text(b"warc-record-id"), kind, text(b"warc-concurrent-to"), text(b"warc-target-uri"), text(b"warc-refers-to"), text(b"warc-date"), text(b"content-type"), digest, size, page, kept)


def read_records(spark: SparkSession, path: str, with_blocks: bool = False) -> DataFrame:
    """The records of gzip archives, one row each, in any order; with_blocks: with their blocks, else block is null.

    A gzip file is one partition's, so its pieces come in order.
    """

    def run(batches):
        open_, names = _Records(with_blocks), [f.split()[0] for f in RECORDS.split(",")]
        types = [{"long": pa.int64(), "binary": pa.binary()}.get(f.split()[1], pa.string()) for f in RECORDS.split(",")]
        for b in batches:
            found = [r for piece in b.column(0).to_pylist() for r in open_.feed(piece)]
            columns = list(zip(*found)) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    pieces = spark.read.option("lineSep", BLANK).text(path).select(F.col("value").cast("binary").alias("value"))
    return map_in_arrow(pieces, run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: record_id, page_id, response (or revisit), request and metadata as structs, refers_to_page."""
    kept = [c for c in records.columns if c not in ("page_id", "concurrent_to")]
    main = records.where(F.col("record_type").isin("response", "revisit")).select("record_id", F.struct(*kept).alias("response"))
    beside = lambda kind, *more: (
        records.where(F.col("record_type") == kind)
        .dropDuplicates(["concurrent_to"])
        .select(F.col("concurrent_to").alias("record_id"), F.struct(*kept).alias(kind), *more)
    )
    captures = main.join(beside("request"), "record_id", "left").join(beside("metadata", F.col("page_id")), "record_id", "left")
    keepers = beside("metadata", F.col("page_id").alias("refers_to_page")).select(F.col("record_id").alias("_keeper"), "refers_to_page")
    # records that refer to none meet nothing under a key of their own: as nulls they would all lie in one partition
    target = F.coalesce("response.refers_to", F.concat(F.lit("none of "), F.col("record_id")))
    return captures.join(keepers, target == F.col("_keeper"), "left").drop("_keeper")
