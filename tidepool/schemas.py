"""Fixed schemas for every dataset the lake reads or writes.

Raw tables are never schema-inferred: inference costs a full extra scan at
scale and silently changes types when one file drifts.
"""

from __future__ import annotations

from .fixed import BAR_FIELDS, DAILY_SERIES_FIELD, RATE_LIMIT_FIELDS
from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, IntegerType, LongType, MapType, StringType,
    StructField, StructType, TimestampType,
)

S, L, I, D, TS = StringType(), LongType(), IntegerType(), DoubleType(), TimestampType()


def _struct(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Column name Spark fills with the original text of a malformed JSON record.
CORRUPT_COL = "_corrupt_record"

# ---------------------------------------------------------------- raw zone
# Raw news: data columns of the landed NDJSON (partition columns come from
# the path: symbol, year, month, day, hour).
RAW_NEWS_DATA = _struct(
    ("source", S), ("asset_class", S), ("dedup_key", S), ("fetched_at", S),
    ("category", S), ("datetime", L), ("headline", S), ("id", L), ("image", S),
    ("related", S), ("summary", S), ("url", S),
)
RAW_NEWS_PARTITIONS = _struct(("symbol", S), ("year", I), ("month", I), ("day", I), ("hour", I))

# Raw daily bars: everything is text in the raw zone; typing is bronze work.
RAW_BARS_DATA = _struct(
    ("source", S), ("asset_class", S), ("symbol", S), ("date", S), ("open", S),
    ("high", S), ("low", S), ("close", S), ("volume", S), ("fetched_at", S),
    ("dedup_key", S),
)
RAW_BARS_PARTITIONS = _struct(("symbol", S), ("year", I), ("month", I), ("day", I))

# Stream archive (news and ticks mixed on one stream), gzip JSON.
RAW_ARCHIVE_DATA = _struct(
    ("source", S), ("asset_class", S), ("symbol", S), ("dedup_key", S),
    ("headline", S), ("summary", S), ("url", S), ("datetime", L),
    ("category", S), ("fetched_at", S),
)
RAW_TICK_DATA = _struct(
    ("source", S), ("asset_class", S), ("symbol", S), ("dedup_key", S), ("price", D), ("volume", D),
    ("timestamp_ms", L), ("conditions", ArrayType(S)), ("fetched_at", S),
)
RAW_ARCHIVE_PARTITIONS = _struct(("year", I), ("month", I), ("day", I), ("hour", I))

# A relay message: {"type": "trade", "data": [{"s","p","v","t","c"}]}.  Price
# and volume are kept as JSON text so the tick key can reuse the number text.
TICK_MESSAGE = StructType([
    StructField("type", S),
    StructField("data", ArrayType(_struct(
        ("s", S), ("p", S), ("v", S), ("t", L), ("c", ArrayType(S))))),
])

# The daily-series payload of the bars provider.
DAILY_SERIES_PAYLOAD = StructType([
    StructField(DAILY_SERIES_FIELD, MapType(S, _struct(*[(f, S) for f in BAR_FIELDS]))),
    *[StructField(f, S) for f in RATE_LIMIT_FIELDS],
])

# ------------------------------------------------------------- bronze zone
BRONZE_NEWS = _struct(
    ("symbol", S), ("dedup_key", S), ("headline", S), ("summary", S),
    ("news_source", S), ("url", S), ("image", S), ("category", S), ("related", S),
    ("published_at", TS), ("event_year", I), ("event_month", I), ("event_day", I),
    ("_ingestion_ts", TS), ("_pipeline", S),
)
BRONZE_NEWS_PARTITIONS = ["symbol", "event_year", "event_month", "event_day"]

# Typed daily bars; a year of one symbol is few rows, so months are the finest folders.
BRONZE_BARS = _struct(
    ("symbol", S), ("dedup_key", S), ("bar_date", DateType()), ("open", D), ("high", D), ("low", D),
    ("close", D), ("volume", L), ("source", S), ("event_year", I), ("event_month", I),
    ("_ingestion_ts", TS), ("_pipeline", S),
)
BRONZE_BARS_PARTITIONS = ["event_year", "event_month"]

# --------------------------------------------------------------- streaming
# What the detector reads off the event stream.
DETECTOR_SOURCE = _struct(
    ("symbol", S), ("headline", S), ("dedup_key", S), ("fetched_at", S), ("datetime", L),
)
