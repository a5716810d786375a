"""A content-addressed archive of WARC records.

A payload is stored once, under its SHA-256. The exact headers of every record are stored apart
and name their payload by that digest; a join gives the whole records back.

An archive is a folder of two tables. ``headers``: one row per record, with the bytes that stand
before its payload. ``payloads``: one row per distinct payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import stored

# Payloads from this size on are archived as one response and revisits of it.
SHARED_BYTES = 1000
# The sources hold no fetch times.
DATE = "1970-01-01T00:00:00Z"
END = "\r\n"
HEADERS = "row LONG, page_id STRING, headers STRING, payload_key BINARY"
PAYLOADS = "payload_key BINARY, payload BINARY"


def _digest(payload: Column) -> Column:
    return F.unhex(F.sha2(payload, 256))


def _field(name: str, value: Column) -> Column:
    """A header line; nothing where ``value`` is null. Control characters would end the line."""
    safe = F.regexp_replace(value, r"[\x00-\x1F\x7F]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(END)), F.lit(""))


def _urn(row: Column) -> Column:
    return F.concat(F.lit("<urn:x-record:"), row.cast("string"), F.lit(">"))


def drafts(pages: DataFrame, id_column: str, url: str, body: str) -> DataFrame:
    """One narrow row per page: a number, its columns as text, and digests of its payload.

    The number is stored, so that every reader of the drafts sees the same.
    """
    payload = F.encode(F.coalesce(F.col(f"`{body}`"), F.lit("")), "UTF-8")
    narrow = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        _digest(payload).alias("payload_key"),
        F.sha1(payload).alias("sha1"),
        F.length(payload).cast("long").alias("n_bytes"),
    )
    return stored(narrow, "drafts")


def typed(rows: DataFrame, shared_bytes: int = SHARED_BYTES) -> DataFrame:
    """Drafts with ``first`` (``id, row`` of the response that a revisit refers to, else null).

    Of rows with equal payloads of ``shared_bytes`` or more the response is the one with the
    largest id, the last one among equal ids; null ids come before all others. Payloads seen once,
    most of them, need no join. Maxima are taken in each map task first, and adaptive execution
    splits a digest that many rows share.
    """
    own = F.struct("id", "row")
    large = rows.where(F.col("n_bytes") >= shared_bytes)
    groups = large.groupBy("payload_key").agg(F.max(own).alias("first"), F.count("*").alias("n"))
    several = groups.where("n > 1").select(F.col("payload_key").alias("_key"), "first")
    joined = rows.join(several, F.col("payload_key") == F.col("_key"), "left").drop("_key")
    other = F.col("first.row") != F.col("row")
    return joined.withColumn("first", F.when(other, F.col("first")))


def header_text(row: DataFrame) -> DataFrame:
    """The bytes of each record before its payload: record headers, then those of the response.

    A revisit's block ends with the response headers, as it carries no payload of its own.
    """
    revisit = F.col("first").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(END + END),
    )
    length = F.length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))
    text = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _urn(F.col("row"))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Refers-To", F.when(revisit, _urn(F.col("first.row")))),
        _field("WARC-Refers-To-Page", F.col("first.id").cast("string")),
        _field(
            "WARC-Profile",
            F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        _field("Content-Length", length.cast("string")),
        F.lit(END),
        http,
    )
    return row.select(
        "row", F.col("id").cast("string").alias("page_id"), text.alias("headers"), "payload_key"
    )


def distinct_payloads(pages: DataFrame, body: str) -> DataFrame:
    """Each payload once with its digest; copies are reduced to one in each map task first.

    The digest is verified: payloads that share it must agree in a second hash and in length.
    """
    payload = F.encode(F.coalesce(F.col(f"`{body}`"), F.lit("")), "UTF-8")
    rows = pages.select(payload.alias("payload")).select(
        _digest(F.col("payload")).alias("payload_key"),
        "payload",
        F.xxhash64("payload").alias("other"),
        F.length("payload").alias("n"),
    )
    groups = rows.groupBy("payload_key").agg(
        F.first("payload").alias("payload"),
        *[f(c).alias(f"{name}_{c}") for c in ("other", "n") for name, f in (("min", F.min), ("max", F.max))],
    )
    same = (F.col("min_other") == F.col("max_other")) & (F.col("min_n") == F.col("max_n"))
    clash = F.raise_error(F.concat(F.lit("different payloads have the digest "), F.hex("payload_key")))
    return groups.select(
        "payload_key", F.when(same, F.col("payload")).otherwise(clash.cast("binary")).alias("payload")
    )


def write_archive(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url: str = "url",
    body: str = "html",
    shared_bytes: int = SHARED_BYTES,
) -> None:
    """Archive every row of ``pages`` under ``path``, a folder that must not hold an archive yet.

    Null bodies are empty payloads, a null url has no header line, rows repeated in full are
    records of their own, other columns are not archived, and no rows give an empty archive.
    """
    headers = header_text(typed(drafts(pages, id_column, url, body), shared_bytes))
    headers.write.parquet(f"{path}/headers")
    distinct_payloads(pages, body).write.parquet(f"{path}/payloads")


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads; one that doesn't have its digest fails the job."""
    rows = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.hex("payload_key")))
    right = _digest(F.col("payload")) == F.col("payload_key")
    return rows.select(
        "payload_key", F.when(right, F.col("payload")).otherwise(damaged.cast("binary")).alias("payload")
    )


def _line(name: str) -> Column:
    """The value of a header line, null if there is none. Only record headers are searched."""
    own = F.substring_index("headers", END + END, 1)
    found = F.regexp_extract(own, rf"\r\n{name}: ([^\r]*)", 1)
    return F.nullif(found, F.lit(""))


def _joined(spark: SparkSession, path: str, payloads: DataFrame) -> DataFrame:
    """Every header row with its payload's row, which must be there."""
    headers = spark.read.schema(HEADERS).parquet(f"{path}/headers")
    found = headers.join(payloads.withColumnRenamed("payload_key", "_key"), F.col("payload_key") == F.col("_key"), "left")
    lost = F.raise_error(F.concat(F.lit("no payload for record "), F.col("row").cast("string")))
    there = F.when(F.col("_key").isNotNull(), F.lit(True)).otherwise(lost.cast("boolean"))
    return found.where(there).drop("_key")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records as they were: ``row, page_id, record_type, record`` (all bytes), ``payload``.

    ``record`` of a revisit ends after its headers; ``payload`` is the full one it stands for.
    """
    rows = _joined(spark, path, _payloads(spark, path))
    kind = _line("WARC-Type")
    head = F.encode("headers", "UTF-8")
    tail = F.encode(F.lit(END + END), "UTF-8")
    whole = F.when(kind == "revisit", F.concat(head, tail)).otherwise(F.concat(head, F.col("payload"), tail))
    return rows.select("row", "page_id", kind.alias("record_type"), whole.alias("record"), "payload")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """What each record says and what its payload is, without moving payloads to the records.

    ``row, page_id, url, record_type, refers_to`` (the id of the response's page),
    ``payload_bytes, payload_digest`` (SHA-1 of the payload as stored). Sizes and digests are
    computed where payloads lie, once per payload, and must be those the headers give.
    """
    facts = _payloads(spark, path).select(
        "payload_key",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    rows = _joined(spark, path, facts)
    wrong = F.raise_error(F.concat(F.lit("wrong digest in record "), F.col("row").cast("string")))
    right = _line("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    return rows.where(F.when(right, F.lit(True)).otherwise(wrong.cast("boolean"))).select(
        "row",
        "page_id",
        _line("WARC-Target-URI").alias("url"),
        _line("WARC-Type").alias("record_type"),
        _line("WARC-Refers-To-Page").alias("refers_to"),
        "payload_bytes",
        "payload_digest",
    )
