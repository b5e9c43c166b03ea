"""Raw-zone scans.

All scans use fixed schemas (no inference pass) and Hive-style partition
discovery from ``col=value`` folders, so partition predicates prune the
file listing (F6) and data predicates reach the JSON/Parquet readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas as S


def _with_corrupt(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(S.CORRUPT_COL, StringType(), True)])


def _full(data: StructType, parts: StructType) -> StructType:
    return StructType(list(data.fields) + [f for f in parts.fields
                                           if f.name not in data.fieldNames()])


def read_json_table(spark: SparkSession, path: str, data_schema: StructType,
                    partition_schema: StructType | None = None, tolerate_malformed: bool = True,
                    base_path: str | None = None, modified_after: str | None = None) -> DataFrame:
    """A partitioned NDJSON table with a fixed schema.

    ``tolerate_malformed`` keeps bad lines (PERMISSIVE, text kept in
    ``_corrupt_record`` for F3/K6); otherwise the read fails on the first bad
    line (FAILFAST).  ``modified_after`` (``yyyy-MM-ddTHH:mm:ss``) reads only
    files changed since then (S3, batch form).  When a column is both a data
    field and a partition folder, the folder value wins.
    """
    schema = _full(data_schema, partition_schema) if partition_schema else data_schema
    reader = spark.read.schema(_with_corrupt(schema) if tolerate_malformed else schema)
    reader = reader.option("mode", "PERMISSIVE" if tolerate_malformed else "FAILFAST")
    if tolerate_malformed:
        reader = reader.option("columnNameOfCorruptRecord", S.CORRUPT_COL)
    if base_path:
        reader = reader.option("basePath", base_path)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.json(path)


def read_raw_news(spark: SparkSession, path: str, **kw) -> DataFrame:
    """The raw news table (malformed lines tolerated)."""
    kw.setdefault("tolerate_malformed", True)
    return read_json_table(spark, path, S.RAW_NEWS_DATA, S.RAW_NEWS_PARTITIONS, **kw)


def read_raw_bars(spark: SparkSession, path: str, **kw) -> DataFrame:
    """The raw bars table, all text; malformed input fails the read."""
    kw.setdefault("tolerate_malformed", False)
    return read_json_table(spark, path, S.RAW_BARS_DATA, S.RAW_BARS_PARTITIONS, **kw)


def stream_json_table(spark: SparkSession, path: str, data_schema: StructType,
                      partition_schema: StructType | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: the same table as a file stream; the checkpoint replaces the bookmark.

    Run with ``trigger(availableNow=True)`` for "everything new since the last
    commit, then stop".
    """
    schema = _full(data_schema, partition_schema) if partition_schema else data_schema
    reader = (spark.readStream.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", S.CORRUPT_COL))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


# Meta-data block of a daily-series payload (holds the symbol).
_META = StructField("Meta Data", S.MapType(StringType(), StringType()), True)
DAILY_SERIES_FILE = StructType(list(S.DAILY_SERIES_PAYLOAD.fields) + [_META])


def read_daily_series(spark: SparkSession, path: str) -> DataFrame:
    """Landed daily-series payload documents (one JSON document per file).

    Returns ``symbol, payload`` where ``symbol`` comes from the path
    (``symbol=X`` folder) when present, else from the document's meta data.
    """
    df = (spark.read.schema(DAILY_SERIES_FILE).option("multiLine", True)
          .option("mode", "PERMISSIVE").json(path))
    sym_meta = F.col("`Meta Data`")["2. Symbol"]
    sym = F.coalesce(F.col("symbol"), sym_meta) if "symbol" in df.columns else sym_meta
    payload = F.struct(*[F.col(f"`{f.name}`").alias(f.name) for f in S.DAILY_SERIES_PAYLOAD.fields])
    return df.select(sym.alias("symbol"), payload.alias("payload"))


def parse_daily_series(df: DataFrame, text_col: str = "payload_text") -> DataFrame:
    """S10 over a table of payload texts (e.g. a landing table of responses)."""
    return df.withColumn("payload", F.from_json(F.col(text_col), S.DAILY_SERIES_PAYLOAD))
