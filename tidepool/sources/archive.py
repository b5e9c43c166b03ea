"""The stream archive (S6): gzip JSON under arrival-time folders.

Records written to the archive by the stream have no delimiter between
them, so one line may hold several JSON objects back to back
(``{...}{...}``).  Spark's JSON reader takes only the first object of such a
line, so a concatenated archive is read as lines of text (gzip and partition
columns as usual), cut where a record starts, and parsed with ``from_json``.
The reader itself cuts at the text every record begins with, so a file without
line ends is read record by record.

A record starts where the envelope starts.  Inside a JSON string quotes are
escaped, so that pattern can't match there; and since every start is a cut,
junk or a truncated record spoils its own piece only.  Pieces that don't
parse keep their text in ``_corrupt_record`` for the error output (K6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas as S

# The envelope's first two fields, in the order the producers write them.
RECORD_START = r'(?=\{"source"\s*:\s*"(?:[^"\\]++|\\.)*+"\s*,\s*"asset_class"\s*:)'

_STRING = r'"(?:[^"\\]++|\\.)*+"'
_FLAT = r"\{(?:[^{}" + '"' + r"]++|" + _STRING + r")*+\}"
# A JSON object by its braces, up to two levels of objects inside it: only to part a
# record from what was written behind it.
_OBJECT = r"\{(?:[^{}" + '"' + r"]++|" + _STRING + "|" + r"\{(?:[^{}" + '"' + r"]++|" + _STRING + "|" + _FLAT + r")*+\}" + r")*+\}"


def _whole(text: Column) -> Column:
    """Whether the text is one JSON value and nothing after it, nested however deep.

    The parser stops at a value's end.  Within brackets whatever follows the value
    makes the text malformed, or a longer array, unless it closes the bracket; and
    what closes a bracket is malformed within a brace.
    """
    elements = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).cast("array<variant>")
    member = F.try_parse_json(F.concat(F.lit('{"k":'), text, F.lit("}")))
    return F.coalesce((F.size(elements) == 1) & member.isNotNull(), F.lit(False))


def split_pieces(lines: DataFrame, text_col: str = "value", keep=(), record_start: str = RECORD_START) -> DataFrame:
    """``keep``, ``piece`` (text, trimmed, not empty) and ``whole`` (one JSON object by itself)."""
    cut = F.explode(F.split(F.col(text_col), record_start, -1)).alias("__p")
    trimmed = F.regexp_replace("__p", r"^\s+|\s+$", "")
    pieces = lines.select(*keep, cut).select(*keep, trimmed.alias("__p")).where("__p <> ''")
    pieces = pieces.withColumn("__whole", _whole(F.col("__p")))
    # a record and what stands behind it (a record cut short, junk) are two pieces
    head = F.when(~F.col("__whole"), F.regexp_extract("__p", f"^{_OBJECT}", 0)).otherwise("")
    pieces = pieces.withColumn("__head", head)
    rest = F.regexp_replace(F.substr("__p", F.length("__head") + 1), r"^\s+", "")

    def piece(text, whole):
        return F.struct(text.alias("piece"), whole.alias("whole"))

    parts = F.when(F.col("__head") == "", F.array(piece(F.col("__p"), F.col("__whole")))).otherwise(
        F.array(piece(F.col("__head"), _whole(F.col("__head"))), piece(rest, _whole(rest))))
    out = pieces.select(*keep, F.explode(parts).alias("__x")).select(*keep, "__x.piece", "__x.whole")
    return out.where("piece <> ''").withColumn("whole", F.col("whole") & F.col("piece").startswith("{"))


def split_records(lines: DataFrame, schema: StructType, text_col: str = "value", keep=(),
                  record_start: str = RECORD_START) -> DataFrame:
    """Text with records back to back → one row per record: ``keep``, the
    fields of ``schema`` and ``_corrupt_record`` (null for good records).

    A piece is good when it is one JSON object of the schema and nothing after it.
    """
    pieces = split_pieces(lines, text_col, keep, record_start)
    parse = StructType([*schema.fields, StructField(S.CORRUPT_COL, StringType())])
    r = F.from_json("piece", parse, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COL})
    good = F.coalesce(F.col("whole") & F.col("r").isNotNull() & F.col(f"r.{S.CORRUPT_COL}").isNull(), F.lit(False))
    return (pieces.withColumn("r", r)
            .select(*keep, *[F.when(good, F.col(f"r.{f.name}")).alias(f.name) for f in schema.fields],
                    F.when(~good, F.col("piece")).alias(S.CORRUPT_COL)))


# What a record of each kind must hold; the first kind that fits is taken.
SHAPES = {"ticks": ("timestamp_ms", "price"), "news": ("headline",)}
OTHER, BAD = "other", "bad"


def route_records(lines: DataFrame, text_col: str = "value", keep=(), record_start: str = RECORD_START) -> DataFrame:
    """A stream archive that holds several kinds of record → typed by shape.

    ``keep``, ``kind`` (ticks, news, other: an object of neither shape, bad: no
    object), the fields of both kinds (null where a record has none, or one of
    another type: a wrong type costs its field only) and ``record`` (the text, for
    other and bad).  Records are parsed once, into VARIANT, and fields read off it.
    """
    pieces = split_pieces(lines, text_col, keep, record_start)
    v = F.when(F.col("whole"), F.try_parse_json("piece"))
    pieces = pieces.withColumn("__v", v)
    kind = F.when(F.col("__v").isNull(), F.lit(BAD))
    for name, needed in SHAPES.items():
        has = F.lit(True)
        for field in needed:
            got = F.try_variant_get("__v", f"$.{field}", "variant")
            has = has & got.isNotNull() & ~F.is_variant_null(got)  # neither absent nor null
        kind = kind.when(has, F.lit(name))
    kind = kind.otherwise(F.lit(OTHER))
    fields = {f.name: f.dataType.simpleString() for t in (S.RAW_ARCHIVE_DATA, S.RAW_TICK_DATA) for f in t.fields}
    return pieces.withColumn("kind", kind).select(
        *keep, "kind", *[F.when(F.col("kind").isin(*SHAPES), F.try_variant_get("__v", f"$.{n}", t)).alias(n)
                         for n, t in fields.items()],
        F.when(~F.col("kind").isin(*SHAPES), F.col("piece")).alias("record"))


def land_mixed(spark: SparkSession, archive_path: str, out_path: str, **reader) -> None:
    """S6/S8 (batch job): the archive in one pass to ``kind=/year=/month=/day=/hour=``
    Parquet folders; folders that the archive's hours touch are replaced."""
    lines = archive_lines(spark, archive_path, **reader)
    hours = [c for c in ("year", "month", "day", "hour") if c in lines.columns]
    routed = route_records(lines, keep=hours)
    (routed.hint("rebalance", "kind", *hours).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("kind", *hours).parquet(out_path))


def read_kind(spark: SparkSession, path: str, kind: str, schema: StructType) -> DataFrame:
    """One kind's table of ``land_mixed``: only its folder and its own fields are read."""
    t = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/kind={kind}")
    return t.select(*schema.fieldNames(), *[c for c in ("year", "month", "day", "hour") if c in t.columns])


# How a producer's record begins.  It parts the records where they are read, so a
# file without any line end is never one cell.  Within a JSON string its quotes
# would be escaped, and records hold no objects that begin so.
RECORD_PREFIX = '{"source"'


def archive_lines(spark: SparkSession, path: str, partition_schema: StructType = S.RAW_ARCHIVE_PARTITIONS,
                  record_prefix: str | None = RECORD_PREFIX) -> DataFrame:
    """``value`` (text of about a record) and the partition columns.

    The reader cuts at ``record_prefix`` instead of line ends; what follows a cut
    gets the prefix back, while a file's text before the first one stays as it is.
    """
    reader = spark.read if record_prefix is None else spark.read.option("lineSep", record_prefix)
    lines = reader.text(path)
    value = F.col("value")
    if record_prefix is not None:
        value = F.when(value.rlike(r"^\s*:"), F.concat(F.lit(record_prefix), value)).otherwise(value)
    parts = [f for f in partition_schema.fields if f.name in lines.columns]
    return lines.select(value.alias("value"), *[F.col(f.name).cast(f.dataType).alias(f.name) for f in parts])


def read_archive(spark: SparkSession, path: str, schema: StructType = S.RAW_ARCHIVE_DATA,
                 partition_schema: StructType = S.RAW_ARCHIVE_PARTITIONS,
                 concatenated: bool = True, record_start: str = RECORD_START) -> DataFrame:
    """Archive records with partition columns and ``_corrupt_record``.

    With ``concatenated=False`` the archive is plain NDJSON and the built-in
    reader is used directly (gzip by extension, splittable per file).
    """
    if not concatenated:
        full = StructType(list(schema.fields) + list(partition_schema.fields)
                          + [StructField(S.CORRUPT_COL, StringType())])
        return (spark.read.schema(full).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", S.CORRUPT_COL).json(path))
    # another start than the producers' has no fixed prefix to read by
    lines = archive_lines(spark, path, partition_schema, RECORD_PREFIX if record_start == RECORD_START else None)
    names = [c for c in lines.columns if c != "value"]
    out = split_records(lines, schema, keep=names, record_start=record_start)
    return out.select(*[f.name for f in schema.fields], *names, S.CORRUPT_COL)
