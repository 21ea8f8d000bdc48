"""Content-addressed WARC archive.

An archive is a folder of two tables. ``payloads`` holds every distinct payload
once under its SHA-256 digest; ``headers`` holds the exact header bytes of every
record, in order, with the digest of its payload. Records are joined back from
the two. Of records with equal payloads of at least ``min_bytes`` bytes, the one
with the largest id is the response; the others are revisits that refer to it.

Digests are verified: when an archive is written, payloads that share a SHA-256
digest must agree in SHA-1 and size (else writing fails); when it is read, both
digests are computed anew from the stored bytes and compared with the key and
with the record's header.

Defined results: one record per row in. A null payload is empty. Rows with the
same id and payload are records of their own, which revisit that id unless they
are the response; of such repeated rows with the largest id all are responses.
A null id is written as ``none`` and is never the largest unless alone. An
empty table gives an archive without records. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm.common import if_small, scratch_path

MIN_REVISIT_BYTES = 1000
# Fixed values of the WARC 1.1 format.
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"


def _urn(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(record_id.cast("string"), F.lit("none")), F.lit(">"))


def _header(record_type: Column, url: Column, record_id: Column, refers_to: Column, sha1: Column, size: Column, date: str) -> Column:
    """Header bytes of a record, as far as the empty line behind them."""
    clean = F.regexp_replace(F.coalesce(url, F.lit("urn:none")), r"[\x00-\x20]", "%20")
    revisit = record_type == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), record_type),
        F.concat(F.lit("WARC-Target-URI: "), clean),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Record-ID: "), _urn(record_id)),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(refers_to))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), sha1),
        F.lit("Content-Type: application/octet-stream"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(size).cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(RECORD_END)).cast("binary")


def write_archive(records: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, date: str = NO_DATE) -> None:
    """Writes ``records(record_id, url, payload binary)`` as an archive."""
    payload = F.coalesce("payload", F.lit(b""))
    keyed = records.select("record_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    # Each distinct payload once: the bytes of a row picked in the map-side half of the aggregation.
    distinct = keyed.groupBy("digest").agg(
        F.first("payload").alias("payload"), F.min(F.struct(F.sha1("payload"), F.length("payload"))).alias("a"),
        F.max(F.struct(F.sha1("payload"), F.length("payload"))).alias("b"))
    clash = F.raise_error(F.concat(F.lit("payloads differ under digest "), F.col("digest")))
    distinct.select("digest", F.when(F.col("a") == F.col("b"), F.col("payload")).otherwise(clash.cast("binary")).alias("payload")
                    ).write.parquet(f"{path}/payloads")
    rows = records.select("record_id", "url", F.sha2(payload, 256).alias("digest"), F.sha1(payload).alias("sha1"),
                          F.length(payload).cast("bigint").alias("size"))
    shared = rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("record_id").alias("largest"), F.count(F.lit(1)).alias("n"))
    largest = if_small(shared.where("n > 1").drop("n"), "warc-largest")
    typed = rows.join(largest, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("record_id").eqNullSafe(F.col("largest")) & F.col("largest").isNotNull(), F.col("largest")))
    kind = F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    typed.select("record_id", "digest", kind.alias("record_type"), "refers_to",
                 _header(kind, F.col("url"), F.col("record_id"), F.col("refers_to"), F.col("sha1"), F.col("size"), date).alias("header")
                 ).write.parquet(f"{path}/headers")


def _field(name: str) -> Column:
    return F.regexp_extract(F.col("header").cast("string"), rf"(?m)^{name}: ?([^\r\n]*)", 1)


def verified_payloads(spark: SparkSession, path: str) -> DataFrame:
    """digest, payload, sha1, size of every stored payload; a payload that does
    not have its digest fails the job."""
    bad = F.raise_error(F.concat(F.lit("stored payload does not match "), F.col("digest")))
    return spark.read.parquet(f"{path}/payloads").select(
        "digest", "payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.sha1("payload")).otherwise(bad).alias("sha1"),
        F.length("payload").cast("bigint").alias("size"))


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of an archive: record_id, record_type, refers_to, header,
    payload_digest (SHA-1) and payload_bytes of the full payload, taken from the
    stored bytes and held against the header; with ``payloads`` also the full
    payload and the record as it stands in a WARC file."""
    stored = verified_payloads(spark, path)
    stored = stored if payloads else stored.drop("payload")
    headers = spark.read.parquet(f"{path}/headers")
    revisit = _field("WARC-Type") == "revisit"
    agrees = ((_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("sha1")))
              & (_field("Content-Length") == F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")))
    bad = F.raise_error(F.concat(F.lit("header and payload disagree: "), F.col("header").cast("string")))
    out = headers.join(stored, "digest").select(
        "record_id", _field("WARC-Type").alias("record_type"), "refers_to", "header",
        F.when(agrees, F.col("sha1")).otherwise(bad).alias("payload_digest"), F.col("size").alias("payload_bytes"),
        *([F.col("payload")] if payloads else []))
    if payloads:
        block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
        out = out.withColumn("record", F.concat("header", block, F.lit(RECORD_END.encode())))
    return out


def _parsed_id(name: str, kind) -> Column:
    """The id in a header line; null where there is none."""
    urn = F.nullif(F.regexp_extract(F.col("header").cast("string"), rf"(?m)^{name}: <urn:page:([^\r\n]*)>", 1), F.lit(""))
    return F.nullif(urn, F.lit("none")).cast(kind)


def parsed_records(records: DataFrame) -> DataFrame:
    """record_id, payload_bytes, payload_digest, record_type and refers_to of
    rebuilt records, from the header and block that each is parsed into; a
    revisit has no block, its digest and size are those of the payload that it
    refers to. A record that is not whole, or whose header names another record
    than its row, fails the job."""
    kind = records.schema["record_id"].dataType
    end = len(RECORD_END)
    head = F.substring_index(F.col("record").cast("string"), RECORD_END, 1)
    size = F.length("record") - F.octet_length("header") - end
    parts = records.withColumn("header", F.concat(head, F.lit(RECORD_END)).cast("binary")).select(
        "record_id", "refers_to", "header", "payload", _field("WARC-Type").alias("record_type"),
        F.substr("record", F.octet_length("header") + 1, size).alias("block"),
        (F.substr("record", F.length("record") - end + 1, F.lit(end)) == F.lit(RECORD_END.encode())).alias("ended"))
    full = parts.withColumn("full", F.when(F.col("record_type") == "revisit", F.col("payload")).otherwise(F.col("block"))).select(
        "record_id", "refers_to", "header", "record_type", "ended", F.length("block").alias("block_bytes"),
        F.length("full").cast("bigint").alias("payload_bytes"), F.sha1("full").alias("sha1"))
    own, refers = _parsed_id("WARC-Record-ID", kind), _parsed_id("WARC-Refers-To", kind)
    whole = (F.col("ended") & own.eqNullSafe(F.col("record_id")) & refers.eqNullSafe(F.col("refers_to")) & F.startswith(F.col("header").cast("string"), F.lit(f"WARC/1.1{CRLF}"))
             & (_field("Content-Length") == F.col("block_bytes").cast("string"))
             & (_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("sha1"))))
    bad = F.raise_error(F.concat(F.lit("rebuilt record does not match its header: "), F.col("header").cast("string")))
    return full.select(own.alias("record_id"), "payload_bytes", F.when(whole, F.col("sha1")).otherwise(bad).alias("payload_digest"),
                       "record_type", refers.alias("refers_to"))


def export_files(spark: SparkSession, path: str, target: str, records_per_file: int = 100_000) -> None:
    """Writes the records of an archive as plain WARC 1.1 files. A record ends in
    an empty line, which is the line separator of the text writer here."""
    body = read_records(spark, path).select(F.expr(f"left(record, length(record) - {len(RECORD_END)})").cast("string").alias("value"))
    body.write.option("lineSep", RECORD_END).option("maxRecordsPerFile", records_per_file).text(target)


def page_records(pages: DataFrame) -> DataFrame:
    """Records of web pages: the html in UTF-8 is the payload."""
    return pages.select(F.col("page_id").alias("record_id"), "url", F.col("html").cast("binary").alias("payload"))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes pages as an archive in the shared folder, reads it back and parses
    every rebuilt record."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(page_records(pages), path)
    return parsed_records(read_records(spark, path)).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
k AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
    max(page_id) OVER (PARTITION BY payload) AS largest FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND largest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND largest <> page_id THEN largest END AS refers_to
FROM k"""
