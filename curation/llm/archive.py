"""Operator 8: content-addressed WARC archive.

``write_archive`` stores each distinct payload once under its SHA-256 and the
exact record headers (WARC and HTTP) apart from it.  ``read_payloads``
verifies every stored payload against its digest while reading;
``read_records`` parses the headers back; ``reconstruct`` joins both into the
original records' bytes; ``export_warc`` writes those as gzip WARC files.

Of records with equal payloads of at least ``min_revisit`` bytes, the one
with the largest id is the ``response`` and the others ``revisit`` it;
smaller payloads are ``response`` every time (their bytes are still stored
once).

Scale: digests are taken where the page is read.  Finding owners moves only
``(id, digest)``.  Payload bytes cross one shuffle, after each map task has
kept one copy per digest, so a payload shared by a third of all pages ships
once per task.  The join of headers with a hot digest is an equi-join whose
large side AQE can split.

Defined results: a null payload is empty; a null url writes no target line;
rows with a null id take part, but an id is only owned by a non-null one (a
group without any gives responses only); a repeated row repeats its record,
and every copy of the owner is a response.  An empty table gives an empty
archive.  Columns beyond id, url and payload are not stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, shared_path, table

MIN_REVISIT = 1000
CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value) -> F.Column:
    """One header line, or nothing when the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))


def _head() -> F.Column:
    """Everything of a record that stands before its payload."""
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF),
                    _line("Content-Length", F.col("bytes").cast("string")), F.lit(CRLF))
    revisit = F.col("kind") == "revisit"
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF), _line("WARC-Type", F.col("kind")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("id").cast("string"), F.lit(">"))),
        # a line end inside a url would end the header line
        _line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]+", " ")),
        _line("WARC-Date", F.col("date")),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("owner").cast("string"), F.lit(">"))),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.lit("Content-Type: application/http;msgtype=response" + CRLF),
        _line("Content-Length", block.cast("string")), F.lit(CRLF), http)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", date: str = "1970-01-01T00:00:00Z",
                  min_revisit: int = MIN_REVISIT) -> str:
    """Write ``path/payloads`` (sha256, payload) and ``path/headers``
    (sha256, head); returns ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha256", F.sha2("payload", 256))
    (rows.groupBy("sha256").agg(F.first("payload").alias("payload"))
     .write.mode("overwrite").parquet(f"{path}/payloads"))
    keys = checkpoint(rows.select("id", "url", "sha256", F.sha1("payload").alias("sha1"),
                                  F.octet_length("payload").cast("long").alias("bytes")))
    owners = checkpoint(keys.where(F.col("bytes") >= min_revisit).groupBy("sha256")
                        .agg(F.max("id").alias("top"), F.count("*").alias("n")).where("n > 1")
                        .select("sha256", "top"))
    owner = F.when(F.col("top").isNotNull() & ~F.col("top").eqNullSafe(F.col("id")), F.col("top"))
    (keys.join(owners, "sha256", "left").withColumn("owner", owner)
     .withColumn("kind", F.when(F.col("owner").isNull(), "response").otherwise("revisit"))
     .withColumn("date", F.lit(date)).select("sha256", _head().alias("head"))
     .write.mode("overwrite").parquet(f"{path}/headers"))
    return path


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``(sha256, payload)``; a payload that does not have its digest fails
    the read."""
    stored = spark.read.parquet(f"{path}/payloads")
    sound = F.sha2("payload", 256) == F.col("sha256")
    return stored.select("sha256", F.when(sound, F.col("payload"))
                         .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "sha256"))
                                    .cast("binary")).alias("payload"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The stored headers and what they say: id, url, kind, refers_to."""
    # header lines stand at the start of the text, before the first empty line
    field = lambda name, value: F.nullif(
        F.regexp_extract("head", rf"\A(?:[^\r\n]+\r\n)*?{name}: {value}\r\n", 1), F.lit(""))
    return spark.read.parquet(f"{path}/headers").select(
        "sha256", "head", field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").cast("long").alias("id"),
        field("WARC-Target-URI", r"([^\r\n]*)").alias("url"),
        field("WARC-Type", "([a-z]+)").alias("kind"),
        field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").cast("long").alias("refers_to"))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """``(id, kind, record, payload)``: the exact bytes of every record, and
    the full payload that it stands for."""
    out = read_records(spark, path).join(read_payloads(spark, path), "sha256")
    body = F.when(F.col("kind") == "response", F.col("payload")).otherwise(F.lit(b""))
    return out.select("id", "kind", "payload",
                      F.concat(F.col("head").cast("binary"), body, F.lit(b"\r\n\r\n")).alias("record"))


def export_warc(spark: SparkSession, path: str, out: str) -> None:
    """Write the reconstructed records as gzip WARC files (UTF-8 payloads)."""
    head_and_body = F.concat(F.col("head"), F.when(F.col("kind") == "response", F.decode("payload", "UTF-8"))
                             .otherwise(F.lit("")))
    (read_records(spark, path).join(read_payloads(spark, path), "sha256")
     .select(head_and_body.alias("value")).write.option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").text(out))


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all ``pages``, then read the archive back."""
    path = write_archive(table(spark, sf_dir, "pages"), shared_path(spark, "archive"))
    # what the stored bytes say, once a payload; then one row a record
    facts = read_payloads(spark, path).select(
        "sha256", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"))
    return read_records(spark, path).join(facts, "sha256").select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("kind").alias("record_type"), "refers_to")


OP8_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS owner
  FROM pages)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND owner <> page_id THEN owner END AS refers_to
FROM p
"""
