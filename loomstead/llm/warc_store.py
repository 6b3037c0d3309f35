"""A content-addressed WARC archive: payload bytes once, record headers apart, joined to read.

``write`` makes two Parquet folders below the archive's path. ``payloads`` holds each distinct
payload once, under its SHA-256; ``headers`` holds the exact header block of one WARC/1.1 record
per page, with the address of its payload. Of the pages with equal payloads the one with the
smallest page_id is a ``response``, the others are ``revisit`` records that refer to it.
``read`` joins the two, checks length and digest of every payload against its record's header
and gives the records back; ``export`` writes them as plain .warc text files.

An address is verified: length and SHA-1 of all payloads under one SHA-256 must agree, or
writing fails. A payload shared by very many pages is never gathered: pages are folded to the
smallest id per digest, and one row per digest is joined back.

Nulls: a null html is an empty payload; null urls give an empty target. A null page_id is never
the smallest, unless all are null. Rows that repeat the smallest page_id of their payload are
all responses; the payload is still stored once. An empty table gives an empty archive.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.llm.common import cut, new_folder, prepared
from loomstead.session import join_per_key

LEAST_BYTES = 0
#: The alphabet of base32, and the base-32 digits of ``conv``.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: WARC dates are to the second; the archive is reproducible, so a crawl time is an argument.
WRITTEN = "2000-01-01T00:00:00Z"
ID_URN = "urn:page:"


def base32_of_hex(hexadecimal):
    """Forty hex digits (a SHA-1) as 32 letters of base32."""
    eights = [
        F.lpad(F.conv(F.substring(hexadecimal, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)
    ]
    return F.translate(F.concat(*eights), DIGITS, BASE32)


def described(pages: DataFrame) -> DataFrame:
    """Pages with their payload's address, SHA-1 and length."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), body.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("address"), base32_of_hex(F.sha1("payload")).alias("digest"),
        F.octet_length("payload").cast("bigint").alias("bytes"),
    )


def _header(kind: str, refers):
    """The header block of a record, up to and with the empty line."""
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.lit(kind)),
        F.concat(F.lit(f"WARC-Record-ID: <{ID_URN}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]+", " ")),
        F.lit(f"WARC-Date: {WRITTEN}"), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
    ]
    if refers is not None:
        lines.append(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        lines.append(F.concat(F.lit(f"WARC-Refers-To: <{ID_URN}"), refers.cast("string"), F.lit(">")))
    lines += [
        F.concat(F.lit("X-Payload-Bytes: "), F.col("bytes")),
        F.concat(F.lit("Content-Length: "), F.col("bytes") if refers is None else F.lit("0")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write the archive of pages (page_id, url, html) to ``path``."""
    rows = described(pages)
    slim = cut(rows.drop("payload"))
    by_address = slim.groupBy("address").agg(
        F.min("page_id").alias("first"), F.min("digest").alias("digest_a"), F.max("digest").alias("digest_z"),
        F.min("bytes").alias("bytes_a"), F.max("bytes").alias("bytes_z"),
    )
    agree = (F.col("digest_a") == F.col("digest_z")) & (F.col("bytes_a") == F.col("bytes_z"))
    checked = F.when(agree, F.col("first")).otherwise(F.raise_error(F.concat(F.lit("payloads differ under "), F.col("address"))))
    firsts = by_address.select("address", checked.alias("first"))
    seen = join_per_key(slim, firsts, ["address"], "inner")
    revisit = (F.col("bytes") >= least_bytes) & F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    header = F.when(revisit, _header("revisit", F.col("first"))).otherwise(_header("response", None))
    seen.select("address", header.alias("header")).write.parquet(f"{path}/headers")
    # Folded before they travel: a payload leaves a task once, however many pages have it.
    stored = rows.groupBy("address").agg(F.first("payload").alias("payload"))
    stored.write.parquet(f"{path}/payloads")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive: header, payload (the full one, also of a revisit) and what
    the header says. A payload that is missing or does not match fails the read."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "address", "payload", F.octet_length("payload").cast("bigint").alias("bytes"),
        F.sha2("payload", 256).alias("sha"), base32_of_hex(F.sha1("payload")).alias("digest"),
    )
    said = headers.select(
        "address", "header",
        F.regexp_extract("header", r"\r\nWARC-Type: (\w+)\r\n", 1).alias("record_type"),
        F.regexp_extract("header", rf"\r\nWARC-Record-ID: <{ID_URN}([^>]*)>\r\n", 1).alias("page_id"),
        F.regexp_extract("header", r"\r\nWARC-Payload-Digest: sha1:(\w+)\r\n", 1).alias("said_digest"),
        F.regexp_extract("header", rf"\r\nWARC-Refers-To: <{ID_URN}([^>]*)>\r\n", 1).alias("refers_to"),
        F.regexp_extract("header", r"\r\nX-Payload-Bytes: (\d+)\r\n", 1).cast("bigint").alias("said_bytes"),
    )
    records = join_per_key(said, payloads, ["address"], "left")
    whole = F.coalesce(
        (F.col("sha") == F.col("address")) & (F.col("digest") == F.col("said_digest")) & (F.col("bytes") == F.col("said_bytes")),
        F.lit(False),
    )
    checked = F.when(whole, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("bad payload under "), F.col("address"))))
    return records.select(
        F.nullif("page_id", F.lit("")).alias("page_id"), "record_type", F.nullif("refers_to", F.lit("")).alias("refers_to"),
        F.col("bytes").alias("payload_bytes"), checked.alias("payload_digest"), "header", "payload",
    )


def export(spark: SparkSession, path: str, folder: str) -> None:
    """Write an archive's records as uncompressed .warc text: header, block, two line ends.
    A response's block is its payload, a revisit's is empty."""
    block = F.when(F.col("record_type") == "response", F.decode("payload", "UTF-8")).otherwise("")
    records = read(spark, path).select(F.concat("header", block).alias("value"))
    records.write.option("lineSep", "\r\n\r\n").text(folder)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages' archive to the shared folder, read it back and list its records."""
    spark = prepared(pages.sparkSession)
    path = new_folder(spark)
    write(pages, path)
    id_type = pages.schema["page_id"].dataType.simpleString()
    return read(spark, path).select(
        F.col("page_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (
  SELECT page_id, body, hex, min(page_id) OVER (PARTITION BY body) AS first FROM p
)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST((CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
