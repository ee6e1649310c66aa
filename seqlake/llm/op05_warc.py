"""WARC: archives written from pages, read back and assembled into captures.

Writing.  A page gives a request, a response or revisit, and a metadata
record; request and metadata name the response's id in WARC-Concurrent-To.
Spark's text writer puts the records into archive files, its line separator
being the empty lines that end a record, so any file system that Spark reaches
will do and a lost task writes its file again.

Reading.  Spark's text reader cuts the archives at the start of a record's
version line, whatever the size of a file.  A payload may hold the same bytes;
then a piece is shorter than its Content-Length says.  Files with such a piece
are put together again by a walk over their pieces in order, one file at a
time.

Assembly.  The records of a capture meet under one key, the id of its response
(a request's or metadata record's WARC-Concurrent-To), in one shuffle, and
come out as one nested row.

Null html counts as an empty payload.  Of rows with one page_id and equal
payloads one is the response and the rest revisit it; a null page_id comes
last.  Line breaks in URLs are percent-encoded.  An empty table gives empty
archives and an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, table, written

VERSION = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
#: Payloads shorter than this are always written whole.
MIN_REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"


def record_id(row: Column, kind: str) -> Column:
    h = F.md5(F.concat_ws(":", row.cast("string"), F.lit(kind)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def record(kind: str | Column, rid: Column, url: Column, block: Column, kind_of_content: str, *more: Column) -> Column:
    """Header lines, an empty line and the block; null header lines are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = F.concat_ws("\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), rid),
                        F.lit("WARC-Date: " + DATE), F.concat(F.lit("WARC-Target-URI: "), url), *more, F.lit("Content-Type: " + kind_of_content),
                        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(lines, F.lit(GAP), block)


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the archives of rows (page_id, url, html) to a folder."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.select(
        "page_id", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"), "html",
        F.monotonically_increasing_id().alias("row"), F.octet_length("html").alias("bytes"), F.sha2(F.col("html").cast("binary"), 256).alias("digest"))
    first = (rows.where(F.col("bytes") >= MIN_REVISIT_BYTES).groupBy("digest")
             .agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "row")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("digest", F.col("first.row").alias("first_row")))
    # only digests that come again, written first: by their size Spark decides whether the pages must be shuffled to them
    rows = rows.join(written(first, "warc-repeats"), "digest", "left").withColumn("again", F.coalesce(F.col("first_row") != F.col("row"), F.lit(False)))

    rid = record_id(F.col("row"), "response")
    together = F.concat(F.lit("WARC-Concurrent-To: "), rid)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(GAP))
    request = record("request", record_id(F.col("row"), "request"), F.col("url"), F.concat(F.lit("GET "), "url", F.lit(" HTTP/1.1" + GAP)),
                     "application/http; msgtype=request", together)
    response = record(F.when(F.col("again"), "revisit").otherwise("response"), rid, F.col("url"),
                      F.when(F.col("again"), http).otherwise(F.concat(http, F.col("html"))), "application/http; msgtype=response",
                      F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
                      F.when(F.col("again"), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                      F.when(F.col("again"), F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("first_row"), "response"))))
    metadata = record("metadata", record_id(F.col("row"), "metadata"), F.col("url"),
                      F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n")), "application/warc-fields", together)
    rows.select(F.explode(F.array(request, response, metadata)).alias("value")).write.option("lineSep", GAP).text(path)


def _header(name: str) -> Column:
    """Value of a header line; null if there is none."""
    v = F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}: *([^\r\n]*)", 1)
    return F.when(v != "", v)


def _stitch(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
    """Whole records of one file: a piece shorter than its Content-Length goes on in the next ones."""
    out: list[bytes] = []
    need = 0
    for value in pieces.sort_values(["block", "at"])["value"]:
        value = bytes(value)
        if need > 0:
            out[-1] += (GAP + VERSION).encode() + value
            need -= len(value) + len(GAP + VERSION)
            continue
        top, _, block = value.partition(GAP.encode())
        size = [int(x.split(b":")[1]) for x in top.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        out.append(value)
        need = (size[0] if size else 0) - len(block)
    return pd.DataFrame({"value": out}, columns=["value"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(type, id, concurrent_to, uri, refers_to, payload_digest, block binary) of every record of the archives."""
    raw = spark.read.option("lineSep", GAP + VERSION).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        F.when(F.startswith("value", F.lit(VERSION)), F.substr("value", F.lit(len(VERSION) + 1))).otherwise(F.col("value")).alias("value"))

    def headed(df: DataFrame) -> DataFrame:
        df = df.withColumn("head", F.substring_index("value", GAP, 1))
        return df.withColumn("size", _header("Content-Length").cast("int")).withColumn("rest", F.octet_length("value") - F.octet_length("head") - len(GAP))

    cut = headed(raw)
    # names of files with torn records, written first: Spark knows their size when it picks the joins
    torn = written(cut.where("rest < size").select("file").distinct(), "warc-torn")
    rows = cut
    if not torn.isEmpty():
        mended = (raw.join(torn, "file", "left_semi").select("file", "block", "at", F.col("value").cast("binary").alias("value"))
                  .groupBy("file").applyInPandas(_stitch, "value binary").select(F.col("value").cast("string").alias("value")))
        rows = headed(cut.join(torn, "file", "left_anti").select("value").unionByName(mended))
    rows = rows.where("value <> ''")
    return rows.select(
        F.lower(_header("WARC-Type")).alias("type"), _header("WARC-Record-ID").alias("id"), _header("WARC-Concurrent-To").alias("concurrent_to"),
        _header("WARC-Target-URI").alias("uri"), _header("WARC-Refers-To").alias("refers_to"), _header("WARC-Payload-Digest").alias("payload_digest"),
        F.expr(f"substring(cast(value as binary), octet_length(head) + {len(GAP) + 1}, size)").alias("block"))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: request, response (or revisit) and metadata under the response's id, and the payload.

    payload is null for a revisit; payload_bytes is what the HTTP header says. The payload stands beside the
    response so that a query without it need not shuffle it.
    """
    main = F.col("type").isin("response", "revisit")
    top = F.expr("substring_index(cast(block as string), '\r\n\r\n', 1)")
    body = F.expr("substring(block, octet_length(substring_index(cast(block as string), '\r\n\r\n', 1)) + 5, octet_length(block))")
    r = records.where(main | F.col("type").isin("request", "metadata")).select(
        F.when(main, F.col("id")).otherwise(F.col("concurrent_to")).alias("capture_id"), "type", "id", "uri", "refers_to", main.alias("main"),
        F.when(main, F.regexp_extract(top, r"(?i)\r\nContent-Length: *(\d+)", 1).cast("long")).alias("payload_bytes"),
        F.when(F.col("type") == "response", body).alias("payload"),
        F.when(F.col("type") == "response", F.sha2(body, 256)).otherwise(F.regexp_replace("payload_digest", "^sha256:", "")).alias("digest"),
        F.when(~main, F.col("block").cast("string")).alias("fields"))
    pick = lambda kind, c: F.max(F.when(F.col("type") == kind, F.col(c)))
    lead = lambda c: F.max(F.when(F.col("main"), F.col(c)))
    g = r.groupBy("capture_id").agg(
        lead("uri").alias("uri"), lead("type").alias("record_type"), lead("payload_bytes").alias("payload_bytes"), lead("digest").alias("payload_digest"),
        lead("refers_to").alias("refers_to_id"), F.max("payload").alias("payload"), pick("request", "id").alias("request_id"),
        pick("request", "fields").alias("request_text"), pick("metadata", "id").alias("metadata_id"), pick("metadata", "fields").alias("metadata_text"))
    return g.select(
        "capture_id", "uri",
        F.struct(F.col("request_id").alias("id"), F.col("request_text").alias("http")).alias("request"),
        F.struct("record_type", "payload_bytes", "payload_digest", "refers_to_id").alias("response"), "payload",
        F.struct(F.col("metadata_id").alias("id"), F.col("metadata_text").alias("fields")).alias("metadata"))


def digest(captures: DataFrame) -> DataFrame:
    """One row per page; a revisit's refers_to is the page of the response it names."""
    page = F.regexp_extract("metadata.fields", r"(?:^|\r\n)page-id: *(-?\d*)", 1)
    rows = captures.select("capture_id", F.when(page != "", page.cast("long")).alias("page_id"), "response.payload_bytes", "response.payload_digest",
                           "response.record_type", "response.refers_to_id")
    rows = written(rows, "warc-pages")
    named = rows.select(F.col("capture_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    again = rows.where("refers_to_id is not null").join(named, "refers_to_id", "left")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return rows.where("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long")).select(cols).unionByName(again.select(cols))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return digest(assemble(read_records(spark, path)))


ORACLE_OP5 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM f"""
