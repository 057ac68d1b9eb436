"""WARC archives: writing pages as request, response and metadata records, reading, and assembling transactions."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, small_or_plain

CRLF = "\r\n"
#: Payloads of fewer bytes are always stored, never revisited.
MIN_REVISIT_BYTES = 1000
#: Uncompressed bytes that an archive file is aimed at.
ARCHIVE_BYTES = 32 << 20

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("warc_type", T.StringType()),
    T.StructField("concurrent_to", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("warc_date", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("fields", T.StringType()), T.StructField("payload", T.BinaryType()),
])


def _urn(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cut_ = [F.substring(h, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut_), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line breaks inside a value become spaces."""
    return F.coalesce(F.concat(F.lit(name + ": "), F.translate(value.cast("string"), "\r\n", "  "), F.lit(CRLF)), F.lit(""))


def _record(headers: list[Column], block: Column) -> Column:
    return F.concat(F.lit("WARC/1.0" + CRLF), *headers, _header("Content-Length", F.octet_length(block)), F.lit(CRLF), block)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "2020-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """Write every page as a request, a response or revisit, and a metadata record under path.

    Of pages with equal payloads of MIN_REVISIT_BYTES or more, the one with the largest page_id is the response; the
    others are revisit records that refer to it and hold no payload. Payloads are grouped by digest and length in a
    small aggregate that is joined back, so no group of copies is ever gathered. A null html is an empty payload; a
    null url leaves its header out; a null page_id never serves as a response for others. Rows that repeat page_id and
    html are written each, under record ids of their own. An empty table writes empty archives; other columns are not
    read. Files hold about ARCHIVE_BYTES.
    """
    p = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    p = p.withColumn("n", F.octet_length("html").cast("long")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    seen = cut(p.groupBy("page_id", "digest", "n").agg(F.count("*").alias("rows")), "warc")
    groups = seen.where((F.col("n") >= MIN_REVISIT_BYTES) & F.col("page_id").isNotNull()).groupBy("digest", "n").agg(F.max("page_id").alias("keeper"), F.sum("rows").alias("copies"))
    total = seen.agg(F.sum("rows").alias("rows"), F.sum(F.col("n") * F.col("rows")).alias("bytes")).first()
    groups = cut(groups.where("copies > 1").drop("copies"), "warc").withColumnsRenamed({"digest": "_d", "n": "_n"})
    p = _numbered(p, seen)
    p = p.join(groups, (F.col("digest") == F.col("_d")) & (F.col("n") == F.col("_n")), "left").drop("_d", "_n")
    again = F.col("keeper").isNotNull() & (F.col("page_id") < F.col("keeper"))
    urn = lambda kind: _urn(kind, F.col("page_id"), F.col("digest"), F.col("_k"))
    kept = _urn("response", F.col("keeper"), F.col("digest"), F.lit("0"))
    main_id = F.when(again, urn("revisit")).otherwise(urn("response"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF), _header("Content-Length", F.col("n")), F.lit(CRLF))
    common = [_header("WARC-Target-URI", F.col("url")), F.lit(f"WARC-Date: {date}{CRLF}")]
    main = _record(
        [
            F.when(again, F.lit("WARC-Type: revisit" + CRLF)).otherwise(F.lit("WARC-Type: response" + CRLF)), _header("WARC-Record-ID", main_id), *common,
            _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            F.when(again, F.concat(_header("WARC-Refers-To", kept), F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest" + CRLF))).otherwise(F.lit("")),
            F.lit("Content-Type: application/http; msgtype=response" + CRLF),
        ],
        F.when(again, http).otherwise(F.concat(http, F.col("html"))),
    )
    host, target = (F.regexp_extract("url", r, 1) for r in (r"^[a-zA-Z]+://([^/\s]*)", r"^[a-zA-Z]+://[^/\s]*(/\S*)"))
    target = F.when(F.coalesce(target, F.lit("")) == "", F.lit("/")).otherwise(target)
    request = _record(
        [F.lit("WARC-Type: request" + CRLF), _header("WARC-Record-ID", urn("request")), *common, _header("WARC-Concurrent-To", main_id), F.lit("Content-Type: application/http; msgtype=request" + CRLF)],
        F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1" + CRLF), _header("Host", host), F.lit(CRLF)),
    )
    metadata = _record(
        [F.lit("WARC-Type: metadata" + CRLF), _header("WARC-Record-ID", urn("metadata")), *common, _header("WARC-Concurrent-To", main_id), F.lit("Content-Type: application/warc-fields" + CRLF)],
        _header("page-id", F.col("page_id")),
    )
    gap = F.lit(CRLF + CRLF)
    per_file = max(1, int(ARCHIVE_BYTES / max(1.0, (total["bytes"] or 0) / max(1, total["rows"] or 0))))
    p.select(F.concat(request, gap, main, gap, metadata).alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", compression).option("maxRecordsPerFile", per_file).text(path)


def _numbered(p: DataFrame, seen: DataFrame) -> DataFrame:
    """p with _k, which tells rows of equal page_id and digest apart: 0 for the first one, and random for null ids.

    Only repeated rows are shuffled to be numbered.
    """
    twice = seen.where("rows > 1 and page_id is not null").select(F.col("page_id").alias("_p"), F.col("digest").alias("_g"))
    same = (F.col("page_id") == F.col("_p")) & (F.col("digest") == F.col("_g"))
    one = F.when(F.col("page_id").isNull(), F.expr("uuid()")).otherwise(F.lit("0"))
    if not twice.limit(1).count():
        return p.withColumn("_k", one)
    twice = small_or_plain(twice, 1_000_000)
    more = p.join(twice, same, "left_semi").withColumn("_k", (F.row_number().over(W.partitionBy("page_id", "digest").orderBy("n")) - 1).cast("string"))
    return p.join(twice, same, "left_anti").withColumn("_k", one).unionByName(more)


class _Stream:
    """Reads a plain or gzip-compressed archive (one member or many) piece by piece."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.buf = memoryview(raw), 0, bytearray()
        self.zip = zlib.decompressobj(31) if raw[:2] == b"\x1f\x8b" else None

    def fill(self) -> bool:
        if self.at >= len(self.raw):
            return False
        piece = bytes(self.raw[self.at : self.at + (1 << 18)])
        self.at += len(piece)
        while piece:
            if self.zip is None:
                self.buf += piece
                break
            self.buf += self.zip.decompress(piece)
            piece = self.zip.unused_data
            if self.zip.eof:
                self.zip = zlib.decompressobj(31)
            else:
                break
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (i := self.buf.find(mark, start)) < 0:
            start = max(0, len(self.buf) - len(mark))
            if not self.fill():
                return None
        out = bytes(self.buf[:i])
        del self.buf[: i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) < n:
            if not self.fill():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out


def parse_records(raw: bytes) -> Iterator[dict]:
    """Records of one archive, by their Content-Length; payload marks inside a payload are not mistaken for records."""
    s = _Stream(raw)
    while True:
        head = s.until(b"\r\n\r\n")
        if head is None:
            if bytes(s.buf).strip():
                raise ValueError("the archive ends inside a header")
            return
        lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = s.take(int(h.get("content-length", 0)))
        s.take(4)
        http = h.get("content-type", "").startswith("application/http")
        payload = block.partition(b"\r\n\r\n")[2] if http else b""
        yield h | {"payload": payload, "fields": None if http else block.decode("utf-8", "replace")}


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under path. The payload's digest and length are computed from its bytes.

    Revisit records have the digest that their header states and no length. With with_payload False payloads stay
    inside the Python workers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v in batch.column(0):
                rows, size = [], 0
                for r in parse_records(v.as_py()):
                    kind = r.get("warc-type")
                    stored = kind == "response"
                    digest = hashlib.sha1(r["payload"]).hexdigest() if stored else (r.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                    rows.append((r.get("warc-record-id"), kind, r.get("warc-concurrent-to"), r.get("warc-refers-to"), r.get("warc-target-uri"), r.get("warc-date"), digest, len(r["payload"]) if stored else None, r["fields"], r["payload"] if stored and with_payload else None))
                    size += len(r["payload"]) if with_payload else 0
                    if len(rows) >= 4096 or size > 16 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=RECORD.names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, main, request, metadata, n_records).

    Records belong to the record that their WARC-Concurrent-To names, and it to itself, so captures may be centred
    on the response or on the request. main is the response or revisit. Of several requests or metadata records the
    largest by id stays; a capture without a response has a null main. Records that repeat a record id are merged; an
    empty input gives an empty result.
    """
    row = F.struct("record_id", "warc_type", "target_uri", "warc_date", "refers_to", "payload_digest", "payload_bytes", "fields", "payload")
    of = lambda *kinds: F.max(F.when(F.col("warc_type").isin(*kinds), row))
    return records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        of("response", "revisit").alias("main"), of("request").alias("request"), of("metadata").alias("metadata"), F.count("*").alias("n_records")
    )


def capture_digests(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits get their response's length and page."""
    c = captures.where("main is not null").select(
        F.col("main.record_id").alias("rid"), F.col("main.warc_type").alias("record_type"), F.col("main.refers_to").alias("to"),
        F.col("main.payload_digest").alias("payload_digest"), F.col("main.payload_bytes").alias("payload_bytes"),
        F.regexp_extract(F.col("metadata.fields"), r"page-id: (-?\d+)", 1).try_cast("long").alias("page_id"),
    )
    c = cut(c, "captures")
    stored = c.where("record_type = 'response'")
    first = stored.select(F.col("rid").alias("_rid"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"))
    again = c.where("record_type = 'revisit'").join(first, F.col("to") == F.col("_rid"), "left")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return stored.withColumn("refers_to", F.lit(None).cast("long")).select(cols).unionByName(
        again.select("page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("_page").alias("refers_to"))
    )
