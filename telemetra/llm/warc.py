"""Content-addressed WARC archive.

A record is split into its exact header bytes and its payload.  Payloads are
stored once, under the SHA-256 of their bytes; headers are stored per record
with that address.  Joining the two gives back each WARC/1.1 record byte for
byte, and what the readers report is parsed from these records.

The payload store is bucketed by address: payloads cross the network once, on
their way into it, and a read moves headers to the payloads' buckets.  The few
payloads that very many records share are read apart, each copied once for
every ``SHARE`` of its records, so that none gathers its records in one task.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage
from ..session import work_dir

CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: Records of one payload that a task reads, at most.
SHARE = 500


@dataclass(frozen=True)
class Archive:
    """``payloads``: (address, payload, copies); ``headers``: (record, address, header, copies);
    ``copies`` is the number of records with that payload."""

    payloads: DataFrame
    headers: DataFrame


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 20 bits, five hex digits, give four characters."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), BASE32_DIGITS, BASE32)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def write(pages: DataFrame, least_bytes: int = 0) -> Archive:
    """Write one record per row of ``pages`` (page_id, url, html).

    The payload is the html in UTF-8 (NULL: empty).  Of the records with equal
    payloads of at least ``least_bytes`` bytes the one with the smallest
    page_id is a response and the others revisit it; smaller payloads are all
    responses.  A NULL page_id comes after all others and is written as an
    empty field; of rows with equal page_id one, always one with that
    payload, is the response.  A NULL url leaves its header out; line breaks
    in a url are percent-encoded.  Other columns are not archived.

    Payloads with one address are compared with the kept one by length and by
    SHA-1, and a mismatch fails the job.  The number of a record is its place
    in the input.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digests = pages.select("page_id", "url", F.monotonically_increasing_id().alias("record"), F.sha2(payload, 256).alias("address"), base32_sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("bytes"))
    digests = stage(digests, "warc-records")  # no payload in here; record numbers are fixed from now on

    # one row per address, combined map-side: a payload that a third of all pages share is not gathered
    order = F.struct(F.col("page_id").isNull(), "page_id", "record")
    first = digests.groupBy("address").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"), F.min("sha1").alias("least"), F.max("sha1").alias("most"), F.min("bytes").alias("short"), F.max("bytes").alias("long"))
    clash = (F.col("least") != F.col("most")) | (F.col("short") != F.col("long"))
    first = first.select("address", "copies", F.col("first.record").alias("first_record"), F.col("first.page_id").alias("first_page"), F.when(clash, F.raise_error(F.lit("two payloads have one address"))).otherwise(F.lit(True)).alias("verified"))

    records = digests.join(first, "address").filter("verified")
    revisit = (F.col("bytes") >= least_bytes) & (F.col("record") != F.col("first_record"))
    page = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page("page_id"), F.lit(">"))),
        F.when(F.col("url").isNotNull(), _line("WARC-Target-URI", url)).otherwise(F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), page("first_page"), F.lit(">")))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8" + CRLF),
        _line("Content-Length", F.col("bytes").cast("string")),
        F.lit(CRLF),
    )
    headers = stage(records.select("record", "address", header.cast("binary").alias("header"), "copies"), "warc-headers")

    # exactly one source row per address brings its bytes; rows are told apart by their place, as above
    bodies = pages.select(payload.alias("payload")).withColumn("address", F.sha2("payload", 256))
    payloads = bodies.groupBy("address").agg(F.first("payload").alias("payload"), F.count(F.lit(1)).alias("copies"))
    return Archive(_store(payloads), headers)


def _store(payloads: DataFrame) -> DataFrame:
    """``payloads`` written below the shared folder in buckets by address, as a catalog table."""
    spark = payloads.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"warc_payloads_{uuid.uuid4().hex[:12]}"
    payloads.write.bucketBy(buckets, "address").sortBy("address").option("path", work_dir(spark, "warc-payloads")).saveAsTable(name)
    return spark.table(name)


def read(archive: Archive) -> DataFrame:
    """(record, warc): every record of the archive, byte for byte."""
    shares = F.ceil(F.col("copies") / SHARE).cast("int")
    often = F.col("copies") > SHARE
    few = archive.headers.filter(~often).join(archive.payloads.filter(~often).drop("copies"), "address")
    spread = archive.payloads.filter(often).withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("copies")
    many = archive.headers.filter(often).withColumn("_share", F.pmod(F.xxhash64("record"), shares)).join(spread, ["address", "_share"])
    both = few.select("record", "header", "payload").unionAll(many.select("record", "header", "payload"))
    return both.select("record", F.concat("header", "payload", F.lit(CRLF + CRLF).cast("binary")).alias("warc"))


def parse(records: DataFrame) -> DataFrame:
    """What each record says of itself, its payload measured and digested anew.

    Fails if the measured length or digest differs from the header's.
    """
    # headers are short and hold no empty line: the payload begins after the first one
    # (one character a byte, so that places in the text are places in the bytes)
    text = records.withColumn("_at", F.instr(F.decode("warc", "ISO-8859-1"), F.lit(CRLF + CRLF)))
    text = text.withColumns({"_head": F.expr("decode(substring(warc, 1, _at - 1), 'UTF-8')"), "_body": F.expr("substring(warc, _at + 4, octet_length(warc) - _at - 7)")})
    field = lambda name, pattern: F.regexp_extract("_head", rf"(?m)^{name}: {pattern}\r?$", 1)
    number = lambda name: F.when(field(name, "<urn:page:(.*)>") != "", field(name, "<urn:page:(.*)>")).cast("long")
    out = text.select(
        number("WARC-Record-ID").alias("page_id"),
        F.octet_length("_body").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("_body")).alias("payload_digest"),
        field("WARC-Type", "(.*)").alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"),
        field("Content-Length", "(.*)").alias("_length"),
        field("WARC-Payload-Digest", "sha1:(.*)").alias("_sha1"),
    )
    same = (F.col("_length") == F.col("payload_bytes").cast("string")) & (F.col("_sha1") == F.col("payload_digest"))
    out = out.withColumn("_same", F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit("a record does not match its header")).cast("boolean")))
    return out.filter("_same").drop("_length", "_sha1", "_same")
