"""A content-addressed WARC archive: payload bytes once by digest, exact record headers apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from policypanel.llm.common import stored

#: Payloads of at least so many bytes are stored as one response that equal ones revisit.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"


def _uuid(*cols: Column) -> Column:
    h = F.md5(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("null")) for c in cols)))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)", 1)


def write_archive(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Writes ``pages`` (page_id, url, html) as two tables below ``path``.

    ``payloads``: key (hex SHA-256) and payload, one row per different payload. ``headers``: one row per
    page, the exact header block of its WARC record and the key of its payload. Of records with equal payloads of at least
    ``REVISIT_BYTES`` bytes the one with the largest page_id is a response and the others revisit it; smaller ones are all
    responses. Null html: empty payload. Null url: an empty target. Null page_id: never the largest unless all are null. Rows
    repeated with the largest page_id are all responses, each record with an id of its own; revisits refer to the first. Line breaks in a url are percent-encoded, so a header is never split. Extra columns
    are left out. Empty table: two empty tables.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    src = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload")).withColumn("key", F.sha2("payload", 256))
    src.groupBy("key").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")

    facts = src.select("page_id", "url", "key", F.concat(F.lit("sha1:"), F.sha1("payload")).alias("digest"), F.octet_length("payload").alias("n"))
    # the number that tells repeated rows apart is written with them, as two plans read it
    facts = stored(facts.withColumn("row", F.monotonically_increasing_id()), "warc-facts")
    last = F.max(F.struct("page_id", (-F.col("row")).alias("row")))
    heads = facts.where(F.col("n") >= REVISIT_BYTES).groupBy("key").agg(last.alias("head")).select(
        "key", F.col("head.page_id").alias("head_id"), (-F.col("head.row")).alias("head_row"))
    facts = facts.join(heads, "key", "left")
    revisit = F.col("head_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("head_id")))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    record_id = lambda page_id, row: _uuid(page_id, row, F.col("key"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "), record_id(F.col("page_id"), F.col("row")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), target,
        F.lit(f"{CRLF}WARC-Page-ID: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f"{CRLF}WARC-Payload-Digest: "), F.col("digest"),
        F.when(
            revisit,
            F.concat(
                F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: "),
                record_id(F.col("head_id"), F.col("head_row")), F.lit(f"{CRLF}WARC-Refers-To-Page-ID: "), F.col("head_id").cast("string"),
            ),
        ).otherwise(""),
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "), F.when(revisit, 0).otherwise(F.col("n")).cast("string"),
        F.lit(CRLF + CRLF),
    )
    facts.select("key", header.alias("header")).write.parquet(f"{path}/headers")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """The header table with its fields parsed from the header blocks."""
    page = _field("WARC-Page-ID")
    ref = _field("WARC-Refers-To-Page-ID")
    return spark.read.schema("key string, header string").parquet(f"{path}/headers").select(
        "key", "header", F.when(page != "", page).cast("long").alias("page_id"), _field("WARC-Type").alias("record_type"),
        _field("WARC-Target-URI").alias("url"), _field("WARC-Payload-Digest").alias("payload_digest"),
        F.when(ref != "", ref).cast("long").alias("refers_to"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The payload table, each payload checked against its key; a payload that does not match raises an error."""
    stored = spark.read.schema("key string, payload binary").parquet(f"{path}/payloads")
    good = F.sha2("payload", 256) == F.col("key")
    return stored.select("key", F.when(good, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("key")))).alias("payload"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records: page_id, record_type, payload (the full one, also of revisits) and record, the
    exact WARC bytes (header block, the payload of a response, two line ends)."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return read_headers(spark, path).join(read_payloads(spark, path), "key").select(
        "page_id", "url", "record_type", "refers_to", "payload", F.concat(F.col("header").cast("binary"), body, F.lit((CRLF + CRLF).encode())).alias("record")
    )


def archive_report(spark: SparkSession, path: str) -> DataFrame:
    """Read back per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest are taken from each stored payload once, before the join with the headers, so no payload is shuffled;
    a header whose digest differs from its payload's raises an error.
    """
    facts = read_payloads(spark, path).select("key", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1"))
    same = F.col("payload_digest") == F.concat(F.lit("sha1:"), F.col("sha1"))
    return read_headers(spark, path).join(facts, "key").select(
        "page_id", "payload_bytes", F.when(same, F.col("sha1")).otherwise(F.raise_error(F.lit("header and payload differ"))).alias("payload_digest"),
        "record_type", "refers_to",
    )
