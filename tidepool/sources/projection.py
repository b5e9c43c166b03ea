"""Partition projection as a report.

A projected table computes its partitions from an enum and integer ranges
instead of listing storage.  Spark lists and prunes by itself, so here the
projection is used for what it can still tell us: the partitions that
*should* exist in a time range, and which of them are missing.

The expected grid is generated with ``sequence`` + ``explode`` (symbols ×
slots of the configured range, bounded by configuration, not by data); the
found side is a partial-aggregated distinct over the data; the report is a
left-anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import NEWS_LOCATION_TEMPLATE

_STEP = {"hour": "1 hour", "day": "1 day"}


def _trunc_ntz(c: Column, granularity: str) -> Column:
    secs = 3600 if granularity == "hour" else 86400
    epoch = F.floor(F.unix_timestamp(c) / secs).cast("bigint") * secs
    return F.timestamp_add("SECOND", epoch, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def expected_partitions(spark: SparkSession, symbols: Sequence[str], start: str, end: str,
                        granularity: str = "hour") -> DataFrame:
    """Expected (symbol, slot) grid of the configured range.

    ``start`` and ``end`` (both inclusive, UTC) are configuration, so the grid's
    size is set by it alone and a wrong timestamp in the data can't blow it up.
    """
    step = F.expr(f"INTERVAL {_STEP[granularity]}")
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    return (spark.createDataFrame([(x,) for x in symbols], "symbol string")
            .withColumn("slot", F.explode(F.sequence(lo, hi, step))))


def found_partitions(df: DataFrame, symbol_col: str, ts_col: str,
                     granularity: str = "hour") -> DataFrame:
    """Distinct (symbol, slot) present in the data."""
    return df.select(F.col(symbol_col).alias("symbol"),
                     _trunc_ntz(F.col(ts_col), granularity).alias("slot")).distinct()


def missing_partitions(df: DataFrame, symbols: Sequence[str], symbol_col: str, ts_col: str,
                       start: str, end: str, granularity: str = "hour") -> DataFrame:
    """Partitions of the configured symbols and range that hold no data, also
    before the first and after the last row.

    Returns ``symbol, year, month, day[, hour]`` as zero-padded text, the way
    the location template spells them.
    """
    expected = expected_partitions(df.sparkSession, symbols, start, end, granularity)
    found = found_partitions(df, symbol_col, ts_col, granularity)
    miss = expected.join(found, ["symbol", "slot"], "left_anti")
    parts = [F.date_format("slot", "yyyy").alias("year"), F.date_format("slot", "MM").alias("month"),
             F.date_format("slot", "dd").alias("day")]
    if granularity == "hour":
        parts.append(F.date_format("slot", "HH").alias("hour"))
    return miss.select("symbol", *parts)


def location(template: str = NEWS_LOCATION_TEMPLATE) -> Column:
    """Render the location template from ``symbol/year/month/day/hour`` columns."""
    fmt = template
    cols = []
    for name in ("symbol", "year", "month", "day", "hour"):
        token = "{" + name + "}"
        if token in fmt:
            fmt = fmt.replace(token, "%s")
            cols.append(F.col(name).cast("string"))
    return F.format_string(fmt, *cols)
