"""WARC archives with revisit resolution.

``write_responses`` writes one response record per page. ``deduplicate`` reads archives,
shuffles only the headers by payload digest, joins each later copy to the original response
and writes new archives in which copies are revisit records with fresh headers. ``read_headers``
and ``read_records`` read archives back.

An archive file is one gzip stream of WARC/1.1 records. Spark's text sink writes it (the
record terminator is the sink's line separator), so files appear only when a task commits and
any file system that Spark knows will do; ``binaryFile`` reads it, and a record's own
Content-Length, never its payload, says where it ends.

Defined results: a null payload is an empty one. A record without a URL or id has no such
header. Equal rows are separate records: of copies with equal ids one is the response. An
empty table gives archives without records. Line breaks in a URL are percent-encoded, so no
value can add a header.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import scratch_path, stored, table

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_BYTES = 1000

HEADERS = ("record_type string, record_id string, page_id long, uri string, date string, digest string, "
           "payload_bytes long, refers_to_id string")
RECORDS = HEADERS + ", http_head string, payload string"


def _header(name: str, value: Column) -> Column:
    """``name: value`` and a line break, or nothing for a null value."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def _uuid(hex32: Column) -> Column:
    parts = [F.substring(hex32, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def http_head(payload_bytes: Column) -> Column:
    return F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    payload_bytes.cast("string"), F.lit(CRLF * 2))


def record(kind: Column, record_id: Column, page_id: Column, uri: Column, date: Column, digest: Column,
           head: Column, payload: Column, refers_to: tuple[Column, Column, Column] | None = None) -> Column:
    """A whole record without its terminator. ``refers_to``: id, URI and date of the original."""
    original, original_uri, original_date = refers_to or (F.lit(None).cast("string"),) * 3
    profile = F.when(original.isNotNull(), F.lit(PROFILE))
    length = F.octet_length(head) + F.octet_length(payload)
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _header("WARC-Type", kind), _header("WARC-Record-ID", record_id),
        _header("WARC-Date", date), _header("WARC-Target-URI", uri),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        _header("WARC-Refers-To", original), _header("WARC-Refers-To-Target-URI", original_uri),
        _header("WARC-Refers-To-Date", original_date), _header("WARC-Profile", profile),
        _header("X-Page-ID", page_id.cast("string")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", length.cast("string")), F.lit(CRLF), head, payload)


def _write(records: DataFrame, path: str) -> None:
    records.write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def write_responses(pages: DataFrame, path: str, page_id: str = "page_id", uri: str = "url",
                    payload: str = "html", date: str = DATE) -> None:
    """One response record per row; the record id follows from the row's id and place."""
    held = pages.select(pages[page_id].cast("long").alias("page_id"), pages[uri].alias("uri"),
                        F.coalesce(pages[payload], F.lit("")).alias("payload"),
                        F.monotonically_increasing_id().alias("row"))
    name = F.md5(F.concat_ws("/", F.col("page_id").cast("string"), F.col("row").cast("string")))
    _write(held.select(record(F.lit("response"), _uuid(name), F.col("page_id"), F.col("uri"), F.lit(date),
                              F.sha1(F.encode("payload", "UTF-8")), http_head(F.octet_length("payload")),
                              F.col("payload")).alias("value")), path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive: headers (names in lower case) and block."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 18)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError("the archive ends within a record")
        yield headers, block


def _row(headers: dict[str, str], block: bytes) -> tuple:
    head, gap, payload = block.partition(b"\r\n\r\n")
    head += gap
    kind = headers.get("warc-type")
    size = len(payload)
    if kind == "revisit":  # the payload is elsewhere; the HTTP head still states its length
        stated = [x for x in head.lower().split(b"\r\n") if x.startswith(b"content-length:")]
        size = int(stated[0].split(b":")[1]) if stated else None
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or hashlib.sha1(payload).hexdigest()
    page = headers.get("x-page-id")
    return (kind, headers.get("warc-record-id"), int(page) if page is not None else None,
            headers.get("warc-target-uri"), headers.get("warc-date"), digest, size,
            headers.get("warc-refers-to"), head, payload)


def _read(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    schema = RECORDS if whole else HEADERS
    names = [c.split(" ")[0] for c in schema.split(", ")]
    strings = pa.string()
    types = [strings, strings, pa.int64(), strings, strings, strings, pa.int64(), strings, strings, strings]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] if i < 8 else r[i].decode("utf-8") for r in rows], types[i])
                 for i in range(len(names))], names=names)

        rows, held = [], 0
        for files in batches:
            for content in files.column(0):
                for headers, block in parse(content.as_py()):
                    rows.append(_row(headers, block if whole else block))
                    held += len(block) if whole else 100
                    if held > 1 << 23:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """A row per record, without its payload."""
    return _read(spark, path, whole=False)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record with the HTTP head and the payload (UTF-8 text)."""
    return _read(spark, path, whole=True)


def revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Records that repeat another's payload of at least ``min_bytes``: their id and the original's headers.

    The original is the copy with the largest page id, then the largest record id. Copies of a
    digest are reduced map-side; the join back splits a digest that many records share.
    """
    large = headers.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes))
    first = (large.groupBy("digest").agg(
        F.max(F.struct("page_id", "record_id", "uri", "date")).alias("o"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", F.col("o.record_id").alias("o_id"), F.col("o.uri").alias("o_uri"),
                               F.col("o.date").alias("o_date")))
    return (large.select("record_id", "digest").join(first, "digest").where("record_id <> o_id")
            .select("record_id", "o_id", "o_uri", "o_date"))


def deduplicate(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_BYTES) -> None:
    """Archives of ``source`` again in ``target``, repeated payloads as revisit records."""
    # Stored, so that the planner knows its size when it chooses how the payloads meet it.
    repeats = stored(revisits(read_headers(spark, source), min_bytes), "revisits")
    held = read_records(spark, source).join(repeats.withColumnRenamed("record_id", "r_id"),
                                            F.col("record_id") == F.col("r_id"), "left")
    again = F.col("o_id").isNotNull()
    _write(held.select(record(
        F.when(again, F.lit("revisit")).otherwise(F.col("record_type")), F.col("record_id"), F.col("page_id"),
        F.col("uri"), F.col("date"), F.col("digest"), F.col("http_head"),
        F.when(again, F.lit("")).otherwise(F.col("payload")),
        (F.coalesce("o_id", "refers_to_id"), F.col("o_uri"), F.col("o_date"))).alias("value")), target)


def resolved(headers: DataFrame) -> DataFrame:
    """Headers with ``refers_to``: the page id of the response that a revisit points to."""
    original = headers.where("record_type = 'response'").select(
        F.col("record_id").alias("o_id"), F.col("page_id").alias("refers_to"))
    again = headers.where("record_type = 'revisit'").join(original, F.col("refers_to_id") == F.col("o_id"), "left")
    rest = headers.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return rest.unionByName(again.drop("o_id"))


def op1_warc_revisits(spark, sf_dir: str) -> DataFrame:
    crawl, archive = scratch_path(spark, "crawl"), scratch_path(spark, "archive")
    write_responses(table(spark, sf_dir, "pages"), crawl)
    deduplicate(spark, crawl, archive)
    headers = stored(read_headers(spark, archive), "headers")
    return resolved(headers).select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"),
                                    "record_type", "refers_to")


OP1_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""
