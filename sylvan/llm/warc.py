"""Content-addressed WARC archive: payload bytes once, record headers apart.

``write_archive`` writes two tables below a folder:

* ``payloads`` (digest, payload, n_bytes, keeper): each distinct payload once,
  addressed by its SHA-256.  The digest is verified while grouping: all
  payloads of a digest must agree in size and in a second, independent hash,
  else the write fails.
* ``headers`` (rec, header, digest): the exact header bytes of every record,
  from the version line to the blank line.

Of records with equal payloads of at least ``min_revisit`` bytes, the one with
the smallest id is the response and the others revisit it.  ``read_records``
reads the archive back: it recomputes every stored payload's digest and joins
headers to payloads on it; ``reconstruct`` gives whole records.

A payload shared by very many records is combined before the shuffle, and the
joins on the digest are plain equi-joins, which adaptive execution splits when
one digest is hot.

Defined results: null text is an empty payload; a null url gives an empty
target; rows repeated with the same smallest id are all responses; a null id
is a revisit if another record of the payload has an id, else a response.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 100

PAYLOADS = "digest string, payload string, n_bytes long, keeper long"
HEADERS = "header string, digest string"
CRLF = "\r\n"


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit: int = MIN_REVISIT_BYTES) -> str:
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    records = pages.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("n_bytes"), F.sha2(payload, 256).alias("digest"))

    second = F.xxhash64("payload")
    stored = (records.groupBy("digest")
              .agg(F.first("payload").alias("payload"), F.min("n_bytes").alias("n_bytes"), F.min("id").alias("keeper"),
                   F.max("n_bytes").alias("n_max"), F.min(second).alias("h_min"), F.max(second).alias("h_max")))
    one = (F.col("n_bytes") == F.col("n_max")) & (F.col("h_min") == F.col("h_max"))
    (stored.select(F.when(one, F.col("digest")).otherwise(F.raise_error(F.lit("two payloads share a digest"))).alias("digest"),
                   "payload", "n_bytes", "keeper")
     .write.parquet(f"{path}/payloads"))

    keepers = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads").select("digest", "keeper")
    keeps = F.col("id").eqNullSafe(F.col("keeper")) | (F.col("n_bytes") < min_revisit)
    kind = F.when(keeps, F.lit("response")).otherwise(F.lit("revisit"))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    lines = F.concat(
        F.lit("WARC/1.1" + CRLF + "WARC-Type: "), kind,
        F.lit(CRLF + "WARC-Record-ID: <urn:page:"), number("id"),
        F.lit(">" + CRLF + "WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]+", " "),
        F.lit(CRLF + "WARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(keeps, F.lit("")).otherwise(F.concat(F.lit(CRLF + "WARC-Refers-To: <urn:page:"), number("keeper"), F.lit(">"))),
        F.lit(CRLF + "Content-Length: "), F.when(keeps, F.col("n_bytes")).otherwise(F.lit(0)).cast("string"),
        F.lit(CRLF + CRLF))
    (records.select("id", "url", "n_bytes", "digest").join(keepers, "digest")
     .select(lines.alias("header"), "digest").write.parquet(f"{path}/headers"))
    return path


def verified_payloads(spark: SparkSession, path: str, with_bytes: bool) -> DataFrame:
    """The payload table, each digest recomputed from the stored bytes."""
    stored = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    right = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")) \
        .otherwise(F.raise_error(F.lit("a stored payload does not match its digest")))
    return stored.select(right.alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                         *(["payload"] if with_bytes else []))


def header_fields(header) -> dict:
    def field(name, pattern):
        got = F.regexp_extract(header, rf"\r\n{name}: {pattern}\r\n", 1)
        return F.when(got != "", got)

    page = r"<urn:page:(-?[0-9]+|-)>"
    return {"page_id": field("WARC-Record-ID", page).try_cast("long"),
            "record_type": field("WARC-Type", "([a-z]+)"), "payload_digest": field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})"),
            "refers_to": field("WARC-Refers-To", page).try_cast("long")}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record in the archive."""
    headers = spark.read.schema(HEADERS).parquet(f"{path}/headers")
    records = headers.select(*(c.alias(n) for n, c in header_fields(F.col("header")).items()))
    sizes = verified_payloads(spark, path, with_bytes=False).withColumnRenamed("digest", "payload_digest")
    return records.join(sizes, "payload_digest").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record, payload``: the record as written, and its full payload (a revisit's from its response)."""
    headers = spark.read.schema(HEADERS).parquet(f"{path}/headers")
    fields = header_fields(F.col("header"))
    body = F.when(fields["record_type"] == "response", F.col("payload")).otherwise(F.lit(""))
    return (headers.join(verified_payloads(spark, path, with_bytes=True), "digest")
            .select(fields["page_id"].alias("page_id"), F.concat("header", body, F.lit(CRLF + CRLF)).alias("record"), "payload"))
