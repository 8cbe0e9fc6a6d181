"""WARC archives as chunked record tables.

Writing: every record becomes rows (record, chunk number) of at most ``chunk_bytes``
of payload, each carrying the SHA-1 of the payload up to and including that chunk; a
chunk row is written as one WARC segment (WARC-Segment-Number, and ``continuation``
records from the second on). So neither writing nor reading ever puts an oversized
payload together: reading streams its chunks in order through one running digest.

The archives are written and read by Spark's text files, so they can lie wherever
Spark can write. Records are told apart at ``CRLF CRLF WARC/1.1 CRLF``; that this never
stands inside a payload is made sure by cutting chunks inside every ``WARC/1.1``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestrel.llm.common import materialize

VERSION = b"WARC/1.1"
END = "\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def cut(payload: bytes | memoryview, size: int) -> Iterator[bytes | memoryview]:
    """Chunks of at most ``size`` bytes (at least one), no UTF-8 character and no
    ``WARC/1.1`` whole across a chunk: the latter is cut after its first letter. The chunks of a
    memoryview are views into it, so no payload is copied as a whole."""
    at, marks = 0, [m.start() + 1 for m in re.finditer(re.escape(VERSION), payload)]
    while True:
        to = min(at + size, len(payload))
        while marks and marks[0] <= at:
            marks.pop(0)
        if marks and marks[0] < to:
            to = marks[0]
        while to < len(payload) and payload[to] & 0xC0 == 0x80 and to > at + 1:
            to -= 1
        yield payload[at:to]
        at = to
        if at >= len(payload):
            return


def classify(pages: DataFrame, least: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, original (the page that a
    revisit refers to, else null). Payloads are equal if length and SHA-1 are."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha1(payload).alias("payload_digest"))
    # only digests are shuffled, and only those that stand more than once come back
    again = materialize(
        rows.where(F.col("payload_bytes") >= least).groupBy("payload_bytes", "payload_digest")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "payloads")
    other = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return (rows.join(again, ["payload_bytes", "payload_digest"], "left")
            .select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                    F.when(other, F.col("newest")).alias("original")))


def chunk_table(records: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk: its record's columns, chunk_no from 1, last, data, digest_so_far.
    A revisit is one chunk without data."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for row in zip(*batch.columns):
                page, url, payload, n, digest, original = row
                whole = memoryview(payload.as_buffer() if original.as_py() is None else b"")
                so_far, done = hashlib.sha1(), 0
                for i, data in enumerate(cut(whole, chunk_bytes), 1):
                    so_far.update(data)
                    done += len(data)
                    out.append((page.as_py(), url.as_py(), n.as_py(), digest.as_py(), original.as_py(),
                                i, done == len(whole), data, so_far.hexdigest()))
                    held += len(data)
                    if held > 4 << 20:
                        yield table(out)
                        out, held = [], 0
            yield table(out)

    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("original", pa.int64()), ("chunk_no", pa.int32()),
              ("last", pa.bool_()), ("data", pa.binary()), ("digest_so_far", pa.string())]

    def table(rows):
        cols = list(zip(*rows)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)],
                                          names=[n for n, _ in fields])

    return records.mapInArrow(task, "page_id long, url string, payload_bytes long, payload_digest string, "
                                    "original long, chunk_no int, last boolean, data binary, digest_so_far string")


def write_archive(records: DataFrame, path: str, chunk_bytes: int = 1 << 16,
                  date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``classify``'s records as WARC 1.1 files into the folder ``path``."""
    def urn(page):
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"),
                        F.col("payload_digest"), F.lit(">"))

    def line(name, value):          # left out where the value is null
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    chunks = chunk_table(records, chunk_bytes)
    revisit, first = F.col("original").isNotNull(), F.col("chunk_no") == 1
    block = F.concat(F.when(first, F.lit(HTTP)).otherwise(F.lit(b"")), F.col("data"))
    block = F.when(revisit, F.lit(b"")).otherwise(block)
    several = ~(first & F.col("last"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    here = urn(F.col("page_id"))
    rid = F.when(first, here).otherwise(
        F.concat(F.expr("left({0}, length({0}) - 1)".format("u")), F.lit(":"), F.col("chunk_no").cast("string"), F.lit(">")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").when(first, "response").otherwise("continuation")),
        line("WARC-Record-ID", rid), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        line("X-Payload-Length", F.when(first, F.col("payload_bytes").cast("string"))),
        line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To", F.when(revisit, urn(F.col("original")))),
        line("WARC-Segment-Number", F.when(several, F.col("chunk_no").cast("string"))),
        line("WARC-Segment-Origin-ID", F.when(~first, F.col("u"))),
        line("WARC-Segment-Total-Length",
             F.when(~first & F.col("last"), (F.col("payload_bytes") + len(HTTP)).cast("string"))),
        line("X-Digest-So-Far", F.when(several, F.concat(F.lit("sha1:"), F.col("digest_so_far")))),
        line("Content-Type", F.when(first, "application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    value = F.concat(F.encode(head, "UTF-8"), block).cast("string")
    chunks.withColumn("u", here).select(value.alias("value")).write.option("lineSep", END).text(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC segment under ``path``: record, its kind and headers, and, for
    segments of oversized payloads only, the data. A whole payload's digest is made here."""
    def urn_page(urn: str | None):
        x = urn.split(":")[2] if urn else "null"
        return None if x == "null" else int(x)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for raw in batch.column(0):
                raw = raw.as_py()
                if raw.startswith(VERSION + b"\r\n"):       # a file's first record
                    raw = raw[len(VERSION) + 2:]
                head, _, body = raw.partition(b"\r\n\r\n")
                h = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n"))
                body = body[:int(h["Content-Length"])]
                if len(body) != int(h["Content-Length"]):
                    raise ValueError(f"record {h['WARC-Record-ID']} is cut short")
                kind, number = h["WARC-Type"], int(h.get("WARC-Segment-Number", 0))
                digest, n, data = None, None, None
                if kind == "revisit":
                    digest, n = h["WARC-Payload-Digest"][5:], int(h["X-Payload-Length"])
                else:
                    payload = body.partition(b"\r\n\r\n")[2] if kind == "response" else body
                    if number:
                        data = payload
                    else:
                        digest, n = hashlib.sha1(payload).hexdigest(), len(payload)
                if number < 2 and digest and digest != h["WARC-Payload-Digest"][5:]:
                    raise ValueError(f"record {h['WARC-Record-ID']} has another digest")
                record = h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"])
                out.append((record, number, urn_page(record), kind, digest, n, data,
                            h.get("X-Digest-So-Far", "sha1:")[5:], urn_page(h.get("WARC-Refers-To"))))
                held += len(data or b"")
                if held > 4 << 20:
                    yield table(out)
                    out, held = [], 0
            yield table(out)

    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]
    names = ["record", "chunk_no", "page_id", "record_type", "payload_digest", "payload_bytes", "data", "so_far", "refers_to"]

    def table(rows):
        cols = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    text = spark.read.schema("value string").option("lineSep", f"{END}WARC/1.1\r\n").text(path)
    return (text.where("octet_length(value) > 0").select(F.col("value").cast("binary"))
            .mapInArrow(task, "record string, chunk_no int, page_id long, record_type string, payload_digest string, "
                              "payload_bytes long, data binary, so_far string, refers_to long"))


def digest_chunks(chunks: DataFrame) -> DataFrame:
    """Records of oversized payloads: their chunks, in order, pass one running digest;
    what each chunk says of the payload so far is held against it. A chunk that comes
    more than once (repeated pages) counts once; the record then comes as often."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, so_far, n, copies, number = None, None, 0, 0, 0

        def done():
            return [(now[1], n, so_far.hexdigest(), "response", None)] * copies if now else []

        out = []
        for batch in batches:
            for record, k, page, data, said in zip(*batch.columns):
                key = (record.as_py(), page.as_py())
                if key != now:
                    out += done()
                    now, so_far, n, copies, number = key, hashlib.sha1(), 0, 0, 0
                k, data = k.as_py(), data.as_py()
                copies += k == 1
                if k == number:
                    continue
                so_far.update(data)
                n, number = n + len(data), number + 1
                if k != number or so_far.hexdigest() != said.as_py():
                    raise ValueError(f"record {key[0]} is broken at segment {k}")
            yield table(out)
            out = []
        yield table(done())

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def table(rows):
        cols = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                          names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return (chunks.select("record", "chunk_no", "page_id", "data", "so_far")
            .repartition("record").sortWithinPartitions("record", "chunk_no").mapInArrow(task, RECORD))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    segments = materialize(read_segments(spark, path), "segments")
    whole = segments.where("chunk_no = 0").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return whole.union(digest_chunks(segments.where("chunk_no > 0")))


def archive(pages: DataFrame, path: str, chunk_bytes: int = 1 << 16, least: int = 1000,
            id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` as WARC files into ``path`` (a new folder) and read them back.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest id is
    a response, the others revisit it; smaller payloads are responses all. Null html is an
    empty payload, a null url leaves out the target. Null ids come back null: such a page
    revisits one with an id, and is a response where none of its copies has one. Repeated
    rows are records of their own. Other columns are not archived; no rows give no rows.
    """
    write_archive(classify(pages, least, id_col, url_col, html_col), path, chunk_bytes)
    return read_archive(pages.sparkSession, path)


SQL = """
SELECT page_id, octet_length(p) AS payload_bytes, sha1(p) AS payload_digest,
       CASE WHEN octet_length(p) >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(p) >= 1000 AND page_id < newest THEN newest END AS refers_to
FROM (SELECT page_id, encode(coalesce(html, '')) AS p, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest
      FROM pages)
"""
