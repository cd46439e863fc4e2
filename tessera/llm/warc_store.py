"""Content-addressed WARC archive.

An archive is two tables in one folder: ``payloads`` holds each distinct
payload once under its SHA-256, ``headers`` the exact header block of every
record. Records are rebuilt by joining the two; payloads are verified against
their digest as they are read. ``write_warc`` and ``read_warc`` exchange whole
records as WARC/1.1 text files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import discard, materialise, release, shared_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"


def base32_of_hex(digest: Column) -> Column:
    """RFC 4648 base32, in upper case, of a hex digest of a multiple of 20 bits."""
    five = [F.conv(F.substring(digest, i, 5), 16, 10).cast("int") for i in range(1, 41, 5)]
    return F.concat(*(F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for v in five for s in (15, 10, 5, 0)))


def payload_columns(payload: Column) -> list[Column]:
    return [F.sha2(payload, 256).alias("digest"), base32_of_hex(F.sha1(payload)).alias("sha1"), F.octet_length(payload).cast("long").alias("payload_bytes")]


def record_uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def header_block() -> Column:
    """The header lines of a record, up to and with the empty line that ends them."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_uri(F.col("page_id"))),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.when(revisit, line("WARC-Refers-To", record_uri(F.col("refers_to")))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit(CRLF),
    )


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write the rows (page_id, url, html) as an archive under ``path``.

    Of records with equal payloads of ``min_bytes`` or more, the one with the
    largest page_id is the response and the others revisit it; smaller ones are
    all responses. A null html is an empty payload and a null url an empty
    URI; a null page_id sorts before all others; rows that repeat the largest
    page_id are all responses. Other columns are ignored.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    seen = materialise(pages.select("page_id", "url", *payload_columns(payload)), "warc-digests")
    first = seen.groupBy("digest").agg(F.max("page_id").alias("response"))
    mine = F.col("page_id").eqNullSafe(F.col("response")) | (F.col("payload_bytes") < min_bytes)
    tag = F.concat("digest", F.lit(":"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    holders = first.select("digest", F.col("response").alias("page_id")).select(tag.alias("tag"))
    rows = pages.select("page_id", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    kept = rows.select(tag.alias("tag"), "digest", "payload").join(holders, "tag", "left_semi").dropDuplicates(["tag"])
    kept.select("digest", "payload").write.parquet(f"{path}/payloads")
    records = seen.join(first, "digest").withColumn("record_type", F.when(mine, "response").otherwise("revisit"))
    records = records.withColumn("refers_to", F.when(~mine, F.col("response")))
    records.select("digest", header_block().alias("header")).write.parquet(f"{path}/headers")
    # what sorted the payloads out goes before anything reads them back; Spark holds on to the last job's files, so headers come last
    discard(seen)
    release(pages.sparkSession)


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?s)\r\n{name}: ([^\r\n]*)\r\n", 1)


def _page(name: str) -> Column:
    return F.regexp_extract(_field(name), "^<urn:page:(.*)>$", 1).try_cast("long")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, url, sha1, digest, header) of every record, parsed from its header block."""
    rows = spark.read.parquet(f"{path}/headers")
    return rows.select(
        _page("WARC-Record-ID").alias("page_id"), _field("WARC-Type").alias("record_type"), _page("WARC-Refers-To").alias("refers_to"), _field("WARC-Target-URI").alias("url"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("sha1"), "digest", "header",
    )


def verified_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(digest, payload, sha1, payload_bytes); reading fails at a payload that isn't what its digest says."""
    rows = spark.read.parquet(f"{path}/payloads").select(F.col("digest").alias("_named"), "payload", *payload_columns(F.col("payload")))
    wrong = F.raise_error(F.concat(F.lit("payload differs from its digest: "), "_named"))
    return rows.select(F.when(F.col("_named") == F.col("digest"), F.col("digest")).otherwise(wrong.cast("string")).alias("digest"), "payload", "sha1", "payload_bytes")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """Original records: every header with its full payload, revisits included."""
    return read_headers(spark, path).drop("sha1").join(verified_payloads(spark, path), "digest")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """As ``reconstruct``, without the bytes: payloads are verified once each, then only their measures are joined."""
    measures = materialise(verified_payloads(spark, path).select("digest", "sha1", "payload_bytes"), "warc-measures")
    return read_headers(spark, path).drop("sha1").join(measures, "digest")


def write_warc(spark: SparkSession, path: str, out: str, max_records: int = 5000) -> None:
    """Write an archive's records as WARC/1.1 files, at most ``max_records`` each. Revisits have no payload."""
    records = reconstruct(spark, path)
    body = F.when(F.col("record_type") == "revisit", "").otherwise(F.decode("payload", "UTF-8"))
    whole = records.select(F.concat("header", body).alias("value"))
    whole.write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", max_records).text(out)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload) of every record of the WARC files under ``path``, found by their Content-Length."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                data, at, heads, bodies = content.as_py(), 0, [], []
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    head = data[at:end]
                    size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    heads.append(head.decode())
                    bodies.append(data[end : end + size])
                    at = end + size + 4
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(bodies, pa.binary())], ["header", "payload"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, "header string, payload binary")


def op10_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    _, sha1, size = payload_columns(F.col("payload"))
    return reconstruct(spark, path).drop("sha1", "payload_bytes").select("page_id", size, sha1.alias("payload_digest"), "record_type", "refers_to")


_B32 = " || ".join(f"substr('{BASE32}', (((('0x' || substr(h, {i}, 5))::BIGINT >> {s}) & 31) + 1)::BIGINT, 1)" for i in range(1, 41, 5) for s in (15, 10, 5, 0))
ORACLE_SQL = {
    "op10_warc_archive": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
     m AS (SELECT t, max(page_id) AS r FROM p GROUP BY t)
SELECT page_id, strlen(p.t)::BIGINT AS payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM r THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM r THEN NULL ELSE r END AS refers_to
FROM p JOIN m ON p.t = m.t""",
}
