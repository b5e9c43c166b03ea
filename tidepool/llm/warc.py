"""WARC archives by a chunked record table.

A record is a table of chunk rows: record id, chunk number, content.  A
payload longer than ``chunk_chars`` is written as a segmented WARC record: the
first segment is the record itself (``WARC-Segment-Number: 1``), the rest are
``continuation`` records that name it, the last one giving the total length.
Each chunk row is one record of the archive, so neither writing nor reading
ever builds a payload in one piece: chunks are cut by one linear pass over the
stored text, and on reading the digest of a segmented payload is carried from
chunk to chunk (``_digests``).

Files are written and read by Spark's text source, so they lie wherever Spark
can write.  Records are told apart by their version line; a chunk never holds
that line, because payloads are also cut inside every occurrence of its first part.  Any
record whose length differs from its Content-Length is reported as invalid.

Payloads are text in UTF-8 (null: empty).  Of records with equal payloads of
at least ``min_revisit_bytes`` the one with the largest id is the response;
the others are written as ``revisit`` records without content, which name it.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION_LINE = "WARC/1.1\r\n"
CHUNK_CHARS = 1 << 16
MIN_REVISIT_BYTES = 1000
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CUT = r"(?<=WARC/1\.)(?=1)"  # the closing line end of a chunk must not complete it either


def decisions(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds payload_bytes, digest (SHA-1 hex) and refers_to (null for responses)
    to rows (id, uri, payload).

    The digests are grouped alone, with partial sums before the shuffle; only
    digests that more than one id has come back to the rows.
    """
    payload = F.coalesce("payload", F.lit(""))
    rows = pages.withColumns({"payload": payload, "payload_bytes": F.octet_length(payload).cast("bigint"),
                              "digest": F.sha1(payload.cast("binary"))})
    first = (rows.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("digest")
             .agg(F.max("id").alias("keeper"), F.min("id").alias("other"))
             .where("keeper <> other").select(F.col("digest").alias("_digest"), "keeper"))
    return (rows.join(first, F.col("digest") == F.col("_digest"), "left")
            .withColumn("refers_to", F.when(F.col("keeper") != F.col("id"), F.col("keeper")))
            .drop("_digest", "keeper"))


def _header(pairs: list[tuple[str, Column]]) -> Column:
    """Header lines; a null value leaves its line out."""
    lines = [F.concat(F.lit(name + ": "), value.cast("string")) for name, value in pairs]
    return F.concat_ws(CRLF, *lines)


def record_rows(decided: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Chunk rows (record_id, segment, value): value is a whole WARC record
    without the line end that closes it."""
    pieces = F.expr(f"flatten(transform(split(payload, '{CUT}', -1), "
                    f"p -> regexp_extract_all(p, '(?s).{{1,{int(chunk_chars)}}}', 0)))")
    empty = F.array(F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    # most payloads are one piece, and need no search by expressions to see it
    cut = (F.length("payload") > int(chunk_chars)) | F.col("payload").contains(VERSION_LINE.strip())
    chunks = (F.when(revisit | (F.col("payload_bytes") == 0), empty).when(cut, pieces)
              .otherwise(F.array("payload")))
    rows = (decided.withColumn("chunks", chunks).withColumn("total", F.size("chunks"))
            .select("id", "uri", "payload_bytes", "digest", "refers_to", "total",
                    F.posexplode("chunks").alias("at", "chunk")))
    segmented, first, last = F.col("total") > 1, F.col("at") == 0, F.col("at") == F.col("total") - 1
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    record = F.concat(F.lit("<urn:record:"), name, F.lit(">"))
    header = _header([
        ("WARC-Type", F.when(~first, "continuation").when(F.col("refers_to").isNotNull(), "revisit")
         .otherwise("response")),
        ("WARC-Record-ID", F.when(first, record).otherwise(
            F.concat(F.lit("<urn:record:"), name, F.lit(":"), F.col("at") + 1, F.lit(">")))),
        ("WARC-Segment-Origin-ID", F.when(~first, record)),
        ("WARC-Segment-Number", F.when(segmented, F.col("at") + 1)),
        ("WARC-Segment-Total-Length", F.when(segmented & last, F.col("payload_bytes"))),
        ("WARC-Date", F.lit(DATE)),
        # line ends in a uri would end the header line
        ("WARC-Target-URI", F.when(first, F.regexp_replace("uri", r"[\r\n]+", "%0A"))),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        ("WARC-Payload-Length", F.when(first, F.col("payload_bytes"))),
        ("WARC-Profile", F.when(F.col("refers_to").isNotNull(), F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(F.col("refers_to").isNotNull(), F.concat(
            F.lit("<urn:record:"), F.col("refers_to"), F.lit(">")))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.octet_length("chunk")),
    ])
    return rows.select(F.col("id").alias("record_id"), (F.col("at") + 1).alias("segment"),
                       F.concat(F.lit(VERSION_LINE), header, F.lit(CRLF * 2), F.col("chunk"),
                                F.lit(CRLF)).alias("value"))


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", uri_col: str = "url",
          payload_col: str = "html", chunk_chars: int = CHUNK_CHARS,
          min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write gzip archives below ``path``, one per task.

    Ids name the records, so they should be unique: of rows that share an id,
    each comes back, but chunked ones only intact if they are equal.  A row
    without an id is written as record ``null`` and refers to nothing.
    """
    src = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       F.col(f"`{uri_col}`").cast("string").alias("uri"),
                       F.col(f"`{payload_col}`").alias("payload"))
    (record_rows(decisions(src, min_revisit_bytes), chunk_chars).select("value")
     .write.option("lineSep", CRLF).option("compression", "gzip").text(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The record table of archives: (type, record_id, origin_id, segment,
    total_length, uri, payload_digest, payload_length, refers_to, content, valid)."""
    parts = F.split(F.col("value"), CRLF * 2, 2)
    rows = (spark.read.option("lineSep", VERSION_LINE).text(path).where("value <> ''")
            .select(F.get(parts, 0).alias("head"), F.get(parts, 1).alias("rest")))

    def field(name: str) -> Column:
        got = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
        return F.when(got != "", got)

    length = field("Content-Length").try_cast("bigint")
    body = F.expr("substring(cast(rest as binary), 1, cast(_length as int))").cast("string")
    return (rows.withColumn("_length", length)
            .select(field("WARC-Type").alias("type"), field("WARC-Record-ID").alias("record_id"),
                    field("WARC-Segment-Origin-ID").alias("origin_id"),
                    F.coalesce(field("WARC-Segment-Number").try_cast("int"), F.lit(1)).alias("segment"),
                    field("WARC-Segment-Total-Length").try_cast("bigint").alias("total_length"),
                    (field("WARC-Segment-Number").isNotNull()).alias("segmented"),
                    field("WARC-Target-URI").alias("uri"),
                    F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("payload_digest"),
                    field("WARC-Payload-Length").try_cast("bigint").alias("payload_length"),
                    field("WARC-Refers-To").alias("refers_to"), body.alias("content"),
                    F.coalesce(F.octet_length("rest") == F.col("_length") + 4, F.lit(False)).alias("valid")))


def _digests(batches):
    """(origin, segment, content) in order -> one row per origin, the digest
    carried from chunk to chunk; ``whole`` if no segment is missing."""
    now, state, size, expected, whole, total = None, None, 0, 0, True, None

    def row():
        ok = whole and total == size
        return pa.RecordBatch.from_arrays(
            [pa.array([now]), pa.array([size], pa.int64()), pa.array([state.hexdigest()]),
             pa.array([ok])], ["origin", "payload_bytes", "digest", "whole"])

    for b in batches:
        for origin, segment, content, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if origin != now:
                if now is not None:
                    yield row()
                now, state, size, expected, whole, total = origin, hashlib.sha1(), 0, 1, True, None
            if segment == expected - 1:
                continue  # the same segment again
            whole &= segment == expected
            expected = segment + 1
            data = content.encode("utf-8", "surrogatepass")
            state.update(data)
            size += len(data)
            total = length if length is not None else total
    if now is not None:
        yield row()


def payloads(records: DataFrame) -> DataFrame:
    """One row per record (segments put together): record_id, type, uri,
    payload_bytes, payload_digest, refers_to, intact.

    Digest and length of a response are computed from its content; those of a
    revisit are the ones it states.  ``intact``: valid, nothing missing, and
    equal to what the record states.
    """
    whole = (records.where("not segmented").withColumn("is_revisit", F.col("type") == "revisit")
             .select("record_id", "type", "uri", "refers_to",
                     F.when(F.col("is_revisit"), F.col("payload_length"))
                     .otherwise(F.octet_length("content").cast("bigint")).alias("payload_bytes"),
                     F.when(F.col("is_revisit"), F.col("payload_digest"))
                     .otherwise(F.sha1(F.col("content").cast("binary"))).alias("digest"),
                     F.col("payload_digest").alias("stated"), "payload_length", "valid"))
    parts = records.where("segmented").withColumn("origin", F.coalesce("origin_id", "record_id"))
    joined = (parts.select("origin", "segment", "content", "total_length")
              .repartition("origin").sortWithinPartitions("origin", "segment")
              .mapInArrow(_digests, "origin string, payload_bytes bigint, digest string, whole boolean"))
    heads = parts.where("segment = 1").select(
        F.col("origin").alias("record_id"), "type", "uri", "refers_to",
        F.col("payload_digest").alias("stated"), "payload_length", "valid")
    bad = parts.groupBy("origin").agg(F.min("valid").alias("all_valid"))
    segmented = (heads.join(joined.join(bad, "origin"), F.col("record_id") == F.col("origin"))
                 .select("record_id", "type", "uri", "refers_to", "payload_bytes", "digest", "stated",
                         "payload_length", (F.col("valid") & F.col("whole") & F.col("all_valid")).alias("valid")))
    return (whole.select(segmented.columns).unionByName(segmented)
            .select("record_id", "type", "uri", "refers_to", "payload_bytes",
                    F.col("digest").alias("payload_digest"),
                    (F.col("valid") & F.col("digest").eqNullSafe(F.col("stated"))
                     & F.col("payload_bytes").eqNullSafe(F.col("payload_length"))).alias("intact")))
