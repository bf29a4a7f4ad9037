"""Web archives in which repeated payloads are stored once.

Headers of all records (never their payloads) are shuffled by payload digest; the record with the smallest id is the
response, the others become revisit records that refer to it. The archives are written anew, with fresh headers, by
Spark's own text writer: a record is one row, and the blank lines that end a record are the line separator. Files are
gzipped as a whole and hold a bounded number of records. Reading parses records by their Content-Length, so payloads may
hold anything, and joins revisits to their responses.

A null html is an empty payload. Payloads shorter than ``least`` bytes are all responses. Of repeated rows (same id, url
and payload) one counts as the response and the rest as revisits of it; rows without an id come after all others, and
refer to, or are, a record without a number. A null or multi-line url is written percent-encoded. Extra columns are
left out. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import gzip
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm.common import chosen, small_batches, stored
from slotwise.session import scratch_path

RECORD_END = "\r\n\r\n"
FILE_BYTES = 32_000_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "1970-01-01T00:00:00Z"


@F.pandas_udf(T.StringType())
def base32_digest(sha1_hex: pd.Series) -> pd.Series:
    return sha1_hex.map(lambda h: base64.b32encode(bytes.fromhex(h)).decode())


def resolve(pages: DataFrame, least: int = 0) -> DataFrame:
    """One row per record to write: page_id, url, digest, bytes, response, refers_to, html (null for revisits).

    Only headers meet by digest. Payloads of responses are shuffled once, by digest and row key; others never are.
    """
    html = F.coalesce(pages["`html`"], F.lit(""))
    row_key = F.concat(
        F.coalesce(pages["`page_id`"].cast("string"), F.lit("null")), F.coalesce(F.concat(F.lit(" "), pages["`url`"]), F.lit("")),
    )
    rows = chosen(pages, digest=F.sha1(html.cast("binary")), row_key=row_key, html=html)
    heads = chosen(pages, digest=F.sha1(html.cast("binary")), row_key=row_key, page_id="page_id", url="url",
                   bytes=F.octet_length(html).cast("long"))
    heads = heads.groupBy("digest", "row_key").agg(
        *(F.first(c).alias(c) for c in ("page_id", "url", "bytes")), F.count("*").alias("n"))
    rank = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row_key")
    firsts = heads.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min(rank).alias("first"))
    placed = heads.join(firsts, "digest", "left").withColumn(
        "alone", F.col("first").isNull()).withColumn("leads", F.col("first.row_key") == F.col("row_key"))
    placed = stored(placed.withColumns({
        "refers_to": F.col("first.page_id"),
        # Of n equal rows the first may be the response; payloads that are too small always are.
        "responses": F.when(F.col("alone"), F.col("n")).when(F.col("leads"), 1).otherwise(0),
    }).drop("first", "alone", "leads"), "warc-heads")
    repeat = lambda times: F.explode(F.sequence(F.lit(1), times.cast("int")))
    leading = placed.filter("responses > 0")
    responses = rows.join(leading, ["digest", "row_key"]).dropDuplicates(["digest", "row_key"])
    responses = responses.select(
        "page_id", "url", "digest", "bytes", F.lit(True).alias("response"), F.lit(None).cast("long").alias("refers_to"),
        "html", repeat(F.col("responses")).alias("copy"))
    revisits = placed.filter("n > responses").select(
        "page_id", "url", "digest", "bytes", F.lit(False).alias("response"), F.col("refers_to").cast("long").alias("refers_to"),
        F.lit(None).cast("string").alias("html"), repeat(F.col("n") - F.col("responses")).alias("copy"))
    return responses.unionByName(revisits).drop("copy")


def record_text(records: DataFrame) -> DataFrame:
    """Each record as one string ``value``: header lines, a blank line, the payload."""
    def uri(key):
        return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))

    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("urn:null")), "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("response"), "response").otherwise("revisit")),
        line("WARC-Record-ID", uri(F.col("page_id"))), line("WARC-Date", F.lit(RECORD_DATE)),
        line("WARC-Target-URI", url), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "base32")),
        F.when(F.col("response"), F.lit("")).otherwise(F.concat(
            line("WARC-Refers-To", uri(F.col("refers_to"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.when(F.col("response"), F.col("bytes")).otherwise(0).cast("string")), F.lit("\r\n"),
    )
    based = records.withColumn("base32", base32_digest("digest"))
    return based.select(F.concat(head, F.coalesce("html", F.lit(""))).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """Write the deduplicated archives of ``pages`` (page_id, url, html) to a folder."""
    small_batches(pages.sparkSession)
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0
    per_file = max(1, int(FILE_BYTES / (mean + 400)))
    text = record_text(resolve(pages, least))
    text.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def parsed(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive: header fields in lower case, and the block."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(fields["content-length"])
        yield fields, content[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def read_archives(spark, path: str) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_digest, payload (null for revisits)."""
    small_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")

    def number(urn: str | None) -> int | None:
        value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return None if value in ("", "null") else int(value)

    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                raw = content.as_buffer()
                raw = gzip.decompress(raw) if bytes(raw[:2]) == b"\x1f\x8b" else raw.to_pybytes()
                rows = []
                for f, block in parsed(raw):
                    rows.append((
                        number(f["warc-record-id"]), f["warc-target-uri"], f["warc-type"], number(f.get("warc-refers-to")),
                        f["warc-payload-digest"].removeprefix("sha1:"), block if f["warc-type"] == "response" else None,
                    ))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    # A file is one row; one file at a time goes to Python.
    return files.mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary")


def archive_report(pages: DataFrame) -> DataFrame:
    """Write archives, read them back, and report each record with the size and digest of its full payload."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    records = read_archives(spark, path)
    # Payloads are checked where they are parsed: a response's digest is computed from its bytes.
    heads = records.select(
        "page_id", "record_type", "refers_to", "payload_digest", F.length("payload").cast("long").alias("bytes"),
        F.sha1("payload").alias("sha1"),
    ).withColumn("digest", F.coalesce(base32_digest(F.coalesce("sha1", F.lit(""))), F.lit("")))
    heads = stored(heads.select(
        "page_id", "record_type", "refers_to", "bytes",
        F.when(F.col("record_type") == "response", F.col("digest")).otherwise(F.col("payload_digest")).alias("digest"),
    ), "warc-read")
    sizes = heads.filter("record_type = 'response'").groupBy("digest").agg(F.max("bytes").alias("size"))
    return heads.join(sizes, "digest").select(
        "page_id", F.coalesce("bytes", "size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", "refers_to",
    )


REPORT_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
  d AS (SELECT page_id, strlen(html) AS bytes, sha1(html) AS h, row_number() OVER (PARTITION BY sha1(html) ORDER BY page_id) AS n,
    min(page_id) OVER (PARTITION BY sha1(html)) AS first FROM p),
  b AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(h, i::INT * 5 + 1, 5))::BIGINT) AS parts FROM d)
SELECT page_id, bytes AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((parts[k // 4 + 1] >> (5 * (3 - k % 4))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n > 1 THEN first END AS refers_to
FROM b
"""
