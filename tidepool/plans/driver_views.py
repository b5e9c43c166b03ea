"""Views that give the driver's test tables the shapes the lake works on.

The driver ships TPC-H-like tables plus an ``events`` table; the lake works
on news articles, anomaly records, ticks and bars.  These adapters are pure
projections (no joins, no shuffles), so every query built on them scans
only the columns it needs and its work grows with the tables.

Mapping (kept in one place; the oracle SQL mirrors it):
- detector stream: symbol = ``event_type``, datetime = epoch seconds of ``ts``
- articles: symbol = ``event_type``, published day = ``ts`` day, url =
  ``user_id`` text, fetched at ``ts`` (an article re-fetched during its day)
- ticks: symbol = ``event_type``, price = ``value``, volume = ``props.k``,
  time = ``ts`` in epoch milliseconds
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, timecols

DAY_SECONDS = 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def detector_stream(spark: SparkSession, sf_dir: str, symbol_col: str = "event_type") -> DataFrame:
    """Detector input: ``symbol, event_id, datetime, published_at`` (P4, the
    detector's own conversion)."""
    ev = table(spark, sf_dir, "events")
    dt = timecols.to_epoch_seconds("ts")
    return ev.select(F.col(symbol_col).cast("string").alias("symbol"), F.col("event_id"),
                     dt.alias("datetime"),
                     timecols.epoch_seconds_to_timestamp_millis(dt).alias("published_at"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-news-shaped rows with their P9 key."""
    ev = table(spark, sf_dir, "events")
    day = F.floor(timecols.to_epoch_seconds("ts") / DAY_SECONDS).cast("bigint") * DAY_SECONDS
    url = F.col("user_id").cast("string")
    return ev.select(
        F.lit("events").alias("source"), F.lit("equity").alias("asset_class"),
        F.col("event_type").alias("symbol"), day.alias("datetime"), url.alias("url"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
         .alias("fetched_at"),
        F.col("ts").alias("fetched_ts"), F.col("event_id").alias("id"),
        F.col("props").alias("headline"), F.col("event_type").alias("category"),
        F.lit(None).cast("string").alias("summary"), F.lit(None).cast("string").alias("image"),
        F.lit(None).cast("string").alias("related"), F.col("value"),
        keys.news_key(F.col("event_type"), day, url).alias("dedup_key"))


TICK_PROPS_SCHEMA = "k BIGINT"


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick-shaped rows: ``symbol, ts, timestamp_ms, price, volume, event_id``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("symbol"), F.col("ts"), F.col("event_id"),
                     timecols.ntz_to_epoch_millis("ts").alias("timestamp_ms"),
                     F.col("value").alias("price"),
                     F.from_json("props", TICK_PROPS_SCHEMA)["k"].alias("volume"))


# Every ``props`` of the test table is well formed, so some are damaged here, by
# event id and the same way in the oracle SQL: cut short, plain text, an array,
# absent.  Bad input is what the parsing operators exist for.
def damaged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    i, p = F.col("event_id"), F.col("props")
    text = (F.when(i % 11 == 3, F.substr(p, F.lit(1), F.length(p) - 1))
             .when(i % 13 == 5, "not json")
             .when(i % 17 == 6, F.concat(F.lit("["), p, F.lit("]")))
             .when(i % 19 == 7, F.lit(None).cast("string")).otherwise(p))
    return ev.withColumn("props", text)


DAMAGED_SQL = """CASE WHEN event_id % 11 = 3 THEN substr(props, 1, length(props) - 1)
  WHEN event_id % 13 = 5 THEN 'not json' WHEN event_id % 17 = 6 THEN '[' || props || ']'
  WHEN event_id % 19 = 7 THEN NULL ELSE props END"""


# A publish response: one error code per record, null where it was taken.
def publish_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    i = F.col("event_id")
    code = F.when(i % 29 == 4, "ThroughputExceeded").when(i % 211 == 9, "InternalFailure")
    return ev.select("event_id", F.col("event_type").alias("symbol"), "ts", code.alias("error_code"))


ERROR_CODE_SQL = """CASE WHEN event_id % 29 = 4 THEN 'ThroughputExceeded'
  WHEN event_id % 211 = 9 THEN 'InternalFailure' END"""


# A change log of the suppliers' sectors: five changes each, over the years of the
# shipments, some of them deletes.  The same way in the oracle SQL.
def sector_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_suppkey, j, since, sector, gone``"""
    s, r = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "region")
    step = s.select("s_suppkey", "s_nationkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("j"))
    days = (F.col("s_suppkey") % 97 + F.col("j") * 430).cast("bigint")
    return (step.join(r, F.col("r_regionkey") == (F.col("s_nationkey") + F.col("j")) % 5)
            .select(F.col("s_suppkey").alias("l_suppkey"), "j",
                    F.timestamp_add("DAY", days, F.expr("TIMESTAMP_NTZ'1995-06-01 00:00:00'")).alias("since"),
                    F.col("r_name").alias("sector"), ((F.col("s_suppkey") + F.col("j")) % 7 == 3).alias("gone")))


SECTOR_CHANGES_SQL = """SELECT s_suppkey, j, TIMESTAMP '1995-06-01' + to_days(CAST(s_suppkey % 97 + j * 430 AS INTEGER)) AS since,
         r_name AS sector, (s_suppkey + j) % 7 = 3 AS gone
  FROM supplier CROSS JOIN (SELECT unnest(range(5)) AS j) t JOIN region ON r_regionkey = (s_nationkey + j) % 5"""
