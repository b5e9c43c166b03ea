"""Registered queries over the driver tables, each with a DuckDB oracle.

Every query reads the given tables (through the projections in
``driver_views``) and runs over them whole.  Column names are aliased the
same on both sides; derived doubles are rounded on both sides; timestamps
are UTC ``timestamp_ntz`` (DuckDB ``TIMESTAMP``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .. import schemas as S
from ..functions import keys, timecols
from ..operators import bronze, dedup, filters, summary, windows
from ..fixed import PUBLISH_CHUNK
from ..sinks.publish import call_report, keyed_records, publish_calls
from . import driver_views as V


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, ops: tuple[str, ...]):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


# ------------------------------------------------------------ SQL snippets
EPOCH_S = "(epoch_us(ts) // 1000000)"
PUB = f"make_timestamp({EPOCH_S} * 1000000)"
DAY = f"({EPOCH_S} // 86400 * 86400)"
ART_KEY = (f"substr(sha256(event_type || '|' || CAST({DAY} AS VARCHAR) || '|' || "
           f"CAST(user_id AS VARCHAR)), 1, 16)")
ART_CTE = f"""art AS (
  SELECT 'events' AS source, event_type AS symbol, {DAY} AS datetime,
         CAST(user_id AS VARCHAR) AS url,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS fetched_at, ts AS fetched_ts,
         event_id AS id, props AS headline, event_type AS category, value,
         {ART_KEY} AS dedup_key
  FROM events)"""


def _tumble_sql(width_sql: str, threshold: int, symbol_sql: str = "event_type") -> str:
    return f"""
SELECT symbol, window_start, window_start + INTERVAL {width_sql} AS window_end, count(*) AS event_count
FROM (SELECT {symbol_sql} AS symbol, time_bucket(INTERVAL {width_sql}, {PUB}) AS window_start
      FROM events)
GROUP BY symbol, window_start
HAVING count(*) >= {threshold}"""


# ------------------------------------------------------------ A1 / F1 / P4
def _anomalies(spark, sf_dir, width, threshold, symbol_col="event_type"):
    stream = V.detector_stream(spark, sf_dir, symbol_col)
    found = windows.detect_anomalies(stream, threshold=threshold, width=width, detected_at=False)
    # the detector's own timestamps, shown as UTC wall clock
    return found.withColumns({c: timecols.utc_wall_clock(c) for c in ("window_start", "window_end")})


@register("a1_anomaly_5m", _tumble_sql("5 MINUTE", 3), ("A1", "F1", "P4"))
def q_a1_anomaly_5m(spark, sf_dir):
    return _anomalies(spark, sf_dir, "5 minutes", 3)


@register("a1_anomaly_1h", _tumble_sql("1 HOUR", 3), ("A1", "F1", "P4"))
def q_a1_anomaly_1h(spark, sf_dir):
    return _anomalies(spark, sf_dir, "1 hour", 3)


@register("a1_anomaly_1d_user", _tumble_sql("1 DAY", 3, "CAST(user_id AS VARCHAR)"),
          ("A1", "F1", "P4"))
def q_a1_anomaly_1d_user(spark, sf_dir):
    return _anomalies(spark, sf_dir, "1 day", 3, "user_id")


@register("a1_window_counts_5m", _tumble_sql("5 MINUTE", 1), ("A1",))
def q_a1_window_counts_5m(spark, sf_dir):
    return _anomalies(spark, sf_dir, "5 minutes", 1)


# ------------------------------------------------------ P3 / P4 / P5 / P21
@register("p_time_columns", f"""
SELECT event_id, {EPOCH_S} AS datetime, {PUB} AS published_at,
       make_timestamp({EPOCH_S} * 1000000) AS published_at_ms,
       CAST(year({PUB}) AS INTEGER) AS event_year, CAST(month({PUB}) AS INTEGER) AS event_month,
       CAST(day({PUB}) AS INTEGER) AS event_day,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       strftime(ts, '%H') AS hour
FROM events""", ("P3", "P4", "P5", "P21"))
def q_time_columns(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    dt = timecols.to_epoch_seconds("ts")
    return (ev.select("event_id", "ts", dt.alias("datetime"))
              .select("event_id", "datetime",
                      timecols.utc_wall_clock(timecols.epoch_seconds_to_timestamp("datetime"))
                      .alias("published_at"),
                      timecols.utc_wall_clock(timecols.epoch_seconds_to_timestamp_millis("datetime"))
                      .alias("published_at_ms"),
                      *timecols.date_parts(timecols.utc_wall_clock(
                          timecols.epoch_seconds_to_timestamp("datetime"))),
                      *timecols.padded_path_parts("ts")))


# --------------------------------------------------------------- keys
@register("p8_bar_key", """
SELECT DISTINCT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS date,
       substr(sha256(event_type || '|' || strftime(ts, '%Y-%m-%d')), 1, 16) AS dedup_key
FROM events""", ("P8", "D2"))
def q_p8_bar_key(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    bars = ev.select(F.col("event_type").alias("symbol"),
                     F.date_format("ts", "yyyy-MM-dd").alias("date")).distinct()
    return bars.withColumn("dedup_key", keys.bar_key("symbol", "date"))


@register("p9_news_key", f"""
WITH {ART_CTE}
SELECT id AS event_id, symbol, datetime, url, dedup_key FROM art""", ("P9",))
def q_p9_news_key(spark, sf_dir):
    return V.articles(spark, sf_dir).select(F.col("id").alias("event_id"), "symbol", "datetime",
                                            "url", "dedup_key")


@register("p10_tick_key", """
WITH t AS (SELECT event_id, event_type AS symbol, (epoch_us(ts) // 1000) AS timestamp_ms, value AS price,
                  CAST(props ->> '$.k' AS BIGINT) AS volume,
                  CAST(event_id + 10000000 AS VARCHAR) || '.5' AS large,
                  '0.000' || CAST(event_id % 9 + 1 AS VARCHAR) AS tiny FROM events),
     h AS (SELECT *, symbol || '|' || CAST(timestamp_ms AS VARCHAR) || '|' AS head FROM t)
SELECT event_id, symbol, timestamp_ms, price, volume,
       substr(sha256(head || CAST(price AS VARCHAR) || '|' || CAST(volume AS VARCHAR)), 1, 16) AS dedup_key,
       substr(sha256(head || large || '|' || CAST(volume AS VARCHAR) || '000000000'), 1, 16) AS large_key,
       substr(sha256(head || tiny || '|' || large || '25'), 1, 16) AS tiny_key
FROM h""", ("P10",))
def q_p10_tick_key(spark, sf_dir):
    t = V.ticks(spark, sf_dir)
    i = F.col("event_id")
    large = F.concat((i + 10000000).cast("string"), F.lit(".5"))
    tiny = F.concat(F.lit("0.000"), (i % 9 + 1).cast("string"))
    volume = F.col("volume").cast("string")

    def key(price, vol):
        return keys.tick_key("symbol", "timestamp_ms", keys.python_number(price), keys.python_number(vol))

    return t.select("event_id", "symbol", "timestamp_ms", "price", "volume",
                    key(F.col("price").cast("string"), volume).alias("dedup_key"),
                    key(large, F.concat(volume, F.lit("000000000"))).alias("large_key"),
                    key(tiny, F.concat(large, F.lit("25"))).alias("tiny_key"))


@register("p15_alert_fields", f"""
WITH a AS ({_tumble_sql("1 HOUR", 3)})
SELECT symbol, window_start, event_count,
       symbol || '|' || strftime(window_start, '%Y-%m-%d %H:%M:%S') AS alert_key,
       substr('{keys.ALERT_SUBJECT_PREFIX}' || symbol || ' - ' || CAST(event_count AS VARCHAR)
              || ' events', 1, 99) AS subject
FROM a""", ("P15", "P16", "A1", "F1"))
def q_p15_alert_fields(spark, sf_dir):
    a = _anomalies(spark, sf_dir, "1 hour", 3)
    return a.select("symbol", "window_start", "event_count",
                    keys.alert_key("symbol", "window_start").alias("alert_key"),
                    keys.alert_subject("symbol", "event_count").alias("subject"))


# ------------------------------------------------------------- filters
# The tick relay keeps ``type = 'trade'``; in the driver events the trade
# messages are the purchases.
TRADE_EVENT_TYPE = "purchase"


@register("f2_trade_filter", f"""
SELECT event_id, user_id, ts, value FROM events WHERE event_type = '{TRADE_EVENT_TYPE}'""",
          ("F2",))
def q_f2_trade_filter(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    return filters.only_type(ev, "event_type", TRADE_EVENT_TYPE).select("event_id", "user_id",
                                                                        "ts", "value")


F5_TODAY, F5_DAYS_BACK = "2024-01-15", 1


@register("f5_date_range", f"""
SELECT event_id, event_type, ts FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '{F5_TODAY}' - INTERVAL {F5_DAYS_BACK} DAY AND DATE '{F5_TODAY}'""",
          ("F5",))
def q_f5_date_range(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    return filters.in_date_range(ev, "ts", F5_TODAY, F5_DAYS_BACK).select("event_id", "event_type",
                                                                         "ts")


F7_TICKERS = " view, Click ,purchase,REFUND"


@register("f7_projection_domain", """
SELECT event_id, upper(event_type) AS symbol, CAST(year(ts) AS INTEGER) AS year FROM events
WHERE upper(event_type) IN ('VIEW', 'CLICK', 'PURCHASE', 'REFUND') AND year(ts) BETWEEN 2024 AND 2030""",
          ("P18", "F7"))
def q_f7_projection_domain(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    # stored symbols are lower case here: the configured list is lowered, not the column,
    # so that the IN and the time range reach the scan
    symbols = [t.lower() for t in keys.parse_ticker_list(F7_TICKERS)]
    rows = filters.in_projection_domain(ev, symbols, "event_type", ts_col="ts")
    return rows.select("event_id", F.upper("event_type").alias("symbol"),
                       F.year("ts").cast("int").alias("year"))


# --------------------------------------------------------------- dedup
@register("d1_copies_per_key", f"""
WITH {ART_CTE}
SELECT dedup_key, symbol, datetime, url, count(*) AS n_copies FROM art
GROUP BY dedup_key, symbol, datetime, url""", ("D1",))
def q_d1_copies_per_key(spark, sf_dir):
    return dedup.copies_per_key(V.articles(spark, sf_dir), bronze.NEWS_IDENTITY)


@register("d1_document_dedup", """
SELECT substr(digest, 1, 16) AS dedup_key, min(doc_id) AS doc_id,
       arg_min(source, doc_id) AS news_source, count(*) AS n_copies
FROM (SELECT sha256(text) AS digest, doc_id, source FROM documents)
GROUP BY digest""", ("D1", "D3"))
def q_d1_document_dedup(spark, sf_dir):
    # grouped by the whole digest; the short key is only shown
    docs = V.table(spark, sf_dir, "documents").select(
        F.sha2("text", 256).alias("digest"), "doc_id", F.col("source").alias("news_source"))
    best = docs.groupBy("digest").agg(
        F.min(F.struct("doc_id", "news_source")).alias("b"), F.count(F.lit(1)).alias("n_copies"))
    return best.select(F.substring("digest", 1, 16).alias("dedup_key"), "b.doc_id", "b.news_source",
                       "n_copies")


@register("d2_distinct_articles", f"""
WITH {ART_CTE}
SELECT DISTINCT dedup_key, symbol, datetime, url FROM art""", ("D2",))
def q_d2_distinct_articles(spark, sf_dir):
    return dedup.distinct_rows(V.articles(spark, sf_dir), ["dedup_key", "symbol", "datetime", "url"])


@register("d3_latest_per_key", f"""
WITH {ART_CTE}
SELECT dedup_key, id AS event_id, symbol, fetched_ts AS fetched_at, value FROM (
  SELECT *, row_number() OVER (PARTITION BY dedup_key, symbol, datetime, url
                               ORDER BY fetched_ts DESC NULLS LAST, id DESC NULLS LAST) AS rn
  FROM art) WHERE rn = 1""", ("D3",))
def q_d3_latest_per_key(spark, sf_dir):
    art = V.articles(spark, sf_dir).select(*bronze.NEWS_IDENTITY, F.col("id").alias("event_id"),
                                           F.col("fetched_ts").alias("fetched_at"), "value")
    return dedup.latest_per_key(art, bronze.NEWS_IDENTITY, ["fetched_at", "event_id"]).select(
        "dedup_key", "event_id", "symbol", "fetched_at", "value")


D4_TTL_DAYS = 7
D4_CTE = f"""rec AS (SELECT event_type || '|' || CAST(user_id AS VARCHAR) AS dedup_key, event_id, ts
                 FROM events),
em(dedup_key, t) AS (
  SELECT dedup_key, min(ts) FROM rec GROUP BY dedup_key
  UNION ALL
  SELECT r.dedup_key, min(r.ts) FROM rec r JOIN em e
    ON r.dedup_key = e.dedup_key AND r.ts >= e.t + INTERVAL {D4_TTL_DAYS} DAY
  GROUP BY r.dedup_key),
emitted AS (SELECT e.dedup_key, min(r.event_id) AS event_id, e.t AS first_seen,
                   epoch_us(e.t) // 1000000 + {D4_TTL_DAYS * 86400} AS expires_at
            FROM em e JOIN rec r ON r.dedup_key = e.dedup_key AND r.ts = e.t
            GROUP BY e.dedup_key, e.t)"""


def _d4_records(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    return ev.select(keys.alert_key("event_type", F.col("user_id").cast("string"), True)
                     .alias("dedup_key"), "event_id", "ts")


def _d4_emitted(spark, sf_dir):
    rec = _d4_records(spark, sf_dir)
    out = dedup.first_seen_with_ttl(rec, ["dedup_key"], "ts", D4_TTL_DAYS * 86400,
                                    order=["ts", "event_id"])
    return out.select("dedup_key", "event_id", "first_seen", "expires_at")


@register("d4_first_seen_ttl", f"""
WITH RECURSIVE {D4_CTE}
SELECT dedup_key, event_id, first_seen, expires_at FROM emitted""", ("D4", "P15", "P20"))
def q_d4_first_seen_ttl(spark, sf_dir):
    return _d4_emitted(spark, sf_dir)


# ------------------------------------------------------------ summaries
@register("a2_alert_batches", f"""
WITH RECURSIVE {D4_CTE},
d AS (SELECT event_id, ts, {V.DAMAGED_SQL} AS props FROM events)
SELECT CAST(CAST(d.ts AS DATE) AS TIMESTAMP) AS batch_date,
       count(*) FILTER (WHERE CASE WHEN json_valid(props) THEN json_type(props) = 'OBJECT' ELSE false END)
         AS records_processed,
       count(x.event_id) AS alerts_sent, count(*) AS batch_size
FROM d LEFT JOIN emitted x ON x.event_id = d.event_id
GROUP BY CAST(CAST(d.ts AS DATE) AS TIMESTAMP)""", ("A2", "D4", "P19"))
def q_a2_alert_batches(spark, sf_dir):
    day = F.to_date("ts").cast("timestamp_ntz").alias("batch_date")
    rec = V.damaged_events(spark, sf_dir).select(day, _is_object("props").alias("processed"))
    sent = _d4_emitted(spark, sf_dir).select(F.to_date("first_seen").cast("timestamp_ntz").alias("batch_date"))
    return summary.batches_with_alerts(rec, sent, "batch_date", "processed")


def _is_object(text):
    """Whether a text parses as one JSON object."""
    return F.coalesce(F.json_object_keys(text).isNotNull(), F.lit(False))


@register("a3_symbol_summary", f"""
WITH p AS (SELECT event_type AS symbol, {V.ERROR_CODE_SQL} AS error_code FROM events)
SELECT symbol, count(*) AS records, count(*) FILTER (WHERE error_code IS NULL) AS published,
       count(error_code) AS errors
FROM p GROUP BY symbol""", ("A3",))
def q_a3_symbol_summary(spark, sf_dir):
    rows = V.publish_attempts(spark, sf_dir).withColumn("ok", F.col("error_code").isNull())
    return summary.per_symbol_summary(rows, "symbol", "ok")


@register("a4_publish_outcome", f"""
SELECT count(*) AS attempted, count(*) FILTER (WHERE error_code IS NULL) AS published,
       count(error_code) AS failed
FROM (SELECT {V.ERROR_CODE_SQL} AS error_code FROM events)""", ("A4",))
def q_a4_publish_outcome(spark, sf_dir):
    return summary.publish_outcome(V.publish_attempts(spark, sf_dir))


@register("l1_first_failures", f"""
SELECT * FROM (SELECT event_id, event_type AS symbol, {V.ERROR_CODE_SQL} AS error_code FROM events)
WHERE error_code IS NOT NULL ORDER BY event_id LIMIT 5""", ("L1", "A4"))
def q_l1_first_failures(spark, sf_dir):
    return summary.first_failures(V.publish_attempts(spark, sf_dir), "event_id").select(
        "event_id", "symbol", "error_code")


# ------------------------------------------------------------- bronze
INGESTION_TS = "2024-02-01 00:00:00"
INGESTION_EPOCH = 1706745600  # the same instant


@register("p1_bronze_news", f"""
WITH {ART_CTE},
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key, symbol, datetime, url
                     ORDER BY fetched_at DESC NULLS LAST, id DESC NULLS LAST) AS rn FROM art)
      WHERE rn = 1)
SELECT symbol, dedup_key, headline, CAST(NULL AS VARCHAR) AS summary, source AS news_source, url,
       CAST(NULL AS VARCHAR) AS image, category, CAST(NULL AS VARCHAR) AS related,
       make_timestamp(datetime * 1000000) AS published_at,
       CAST(year(make_timestamp(datetime * 1000000)) AS INTEGER) AS event_year,
       CAST(month(make_timestamp(datetime * 1000000)) AS INTEGER) AS event_month,
       CAST(day(make_timestamp(datetime * 1000000)) AS INTEGER) AS event_day,
       TIMESTAMP '{INGESTION_TS}' AS _ingestion_ts, '{bronze.PIPELINE_NAME}' AS _pipeline
FROM d""", ("P1", "P2", "P3", "P5", "P6", "D1", "D3"))
def q_p1_bronze_news(spark, sf_dir):
    out = bronze.bronze_news(V.articles(spark, sf_dir),
                             ingestion_ts=F.timestamp_seconds(F.lit(INGESTION_EPOCH)))
    return out.withColumns({c: timecols.utc_wall_clock(c) for c in ("published_at", "_ingestion_ts")})


@register("a5_bronze_count", f"""
WITH {ART_CTE} SELECT count(DISTINCT dedup_key) AS n_rows FROM art""", ("A5",))
def q_a5_bronze_count(spark, sf_dir):
    return summary.row_count(q_p1_bronze_news(spark, sf_dir))


# ---------------------------------------------------------- keyed publish
@register("k4_publish_keys", """
SELECT COALESCE(event_type, 'UNKNOWN') AS key, event_id, ts FROM events""", ("K4",))
def q_k4_publish_keys(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), "event_id", "ts")
    return keyed_records(ev, "symbol", order_cols=["ts", "event_id"]).select("key", "event_id", "ts")


_CALLS_CTE = f"""c AS (SELECT COALESCE(event_type, 'UNKNOWN') AS key, event_id, {V.ERROR_CODE_SQL} AS error_code,
  (row_number() OVER (PARTITION BY COALESCE(event_type, 'UNKNOWN') ORDER BY ts, event_id) - 1)
    // {PUBLISH_CHUNK} AS chunk_no FROM events)"""


def _calls(spark, sf_dir):
    keyed = V.publish_attempts(spark, sf_dir).withColumn("key", keys.symbol_or_unknown("symbol"))
    return publish_calls(keyed, "ts", ["event_id"])


@register("k4_publish_chunks", f"WITH {_CALLS_CTE} SELECT key, event_id, chunk_no FROM c", ("K4",))
def q_k4_publish_chunks(spark, sf_dir):
    return _calls(spark, sf_dir).select("key", "event_id", "chunk_no")


@register("k4_call_report", f"""
WITH {_CALLS_CTE}, f AS (
  SELECT key, chunk_no, event_id, error_code,
         row_number() OVER (PARTITION BY key, chunk_no ORDER BY event_id) AS n
  FROM c WHERE error_code IS NOT NULL),
t AS (SELECT key, chunk_no, string_agg(event_id || ':' || error_code, ',' ORDER BY event_id) AS firsts
      FROM f WHERE n <= 5 GROUP BY key, chunk_no),
r AS (SELECT key, chunk_no, count(*) AS n_records, count(error_code) AS n_failed FROM c GROUP BY key, chunk_no)
SELECT r.key, r.chunk_no, n_records, n_failed, COALESCE(firsts, '') AS first_failures
FROM r LEFT JOIN t ON t.key = r.key AND t.chunk_no = r.chunk_no""", ("K4", "A4", "L1"))
def q_k4_call_report(spark, sf_dir):
    report = call_report(_calls(spark, sf_dir), ["event_id"])
    shown = F.array_join(F.transform("first_failures", lambda x: F.concat_ws(
        ":", x["event_id"].cast("string"), x["error_code"])), ",")
    return report.withColumn("first_failures", shown)


# ------------------------------------------------------ partition projection
# The configured range reaches beyond the data at both ends.
S7_SYMBOLS = ("CLICK", "VIEW", "PURCHASE", "SIGNUP", "ERROR", "REFUND")
S7_RANGE = ("2023-12-31 00:00:00", "2024-02-01 23:00:00")


@register("s7_missing_partitions", f"""
WITH exp AS (SELECT s.symbol, g.slot
        FROM (VALUES {", ".join(f"('{s}')" for s in S7_SYMBOLS)}) s(symbol),
             (SELECT unnest(generate_series(TIMESTAMP '{S7_RANGE[0]}', TIMESTAMP '{S7_RANGE[1]}',
                                            INTERVAL 1 HOUR)) AS slot) g),
found AS (SELECT DISTINCT upper(event_type) AS symbol, time_bucket(INTERVAL 1 HOUR, ts) AS slot
          FROM events)
SELECT symbol, strftime(slot, '%Y') AS year, strftime(slot, '%m') AS month,
       strftime(slot, '%d') AS day, strftime(slot, '%H') AS hour
FROM exp ANTI JOIN found USING (symbol, slot)""", ("S7", "P21"))
def q_s7_missing_partitions(spark, sf_dir):
    from ..sources.projection import missing_partitions
    ev = V.table(spark, sf_dir, "events").select(F.upper("event_type").alias("symbol"), "ts")
    return missing_partitions(ev, S7_SYMBOLS, "symbol", "ts", *S7_RANGE)


# --------------------------------------------------------- malformed records
_PROPS_STRUCT = StructType([StructField("k", LongType())])

@register("f3_parse_payloads", f"""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM (SELECT event_id, {V.DAMAGED_SQL} AS props FROM events)
WHERE json_valid(props) AND json_type(props) = 'OBJECT'""", ("F3", "P19"))
def q_f3_parse_payloads(spark, sf_dir):
    from ..streaming.detector import parse_records
    ev = V.damaged_events(spark, sf_dir).select("event_id", F.col("props").alias("value"))
    good, _bad = parse_records(ev, schema=_PROPS_STRUCT, keep=["event_id"])
    return good.select("event_id", "k")


@register("f3_malformed_payloads", f"""
SELECT event_id, props AS _corrupt_record
FROM (SELECT event_id, {V.DAMAGED_SQL} AS props FROM events)
WHERE NOT CASE WHEN json_valid(props) THEN json_type(props) = 'OBJECT' ELSE false END""", ("F3", "W8", "K6"))
def q_f3_malformed_payloads(spark, sf_dir):
    from ..streaming.detector import parse_records
    ev = V.damaged_events(spark, sf_dir).select("event_id", F.col("props").alias("value"))
    return parse_records(ev, schema=_PROPS_STRUCT, keep=["event_id"])[1]


# Two records and, for some events, junk or a record cut short between them, on
# one line without any delimiter: what the stream archive holds.
@register("s6_split_archive", """
SELECT event_id, 'a' AS dedup_key, event_type AS symbol, props AS headline, false AS bad FROM events
UNION ALL SELECT event_id, 'b', event_type, 'x}{"source":y' || chr(34), false FROM events
UNION ALL SELECT event_id, NULL, NULL, NULL, true FROM events WHERE event_id % 5 IN (1, 2)
""", ("S6", "K6"))
def q_s6_split_archive(spark, sf_dir):
    from ..sources.archive import split_records
    ev = V.table(spark, sf_dir, "events")

    def record(key, headline):
        return F.to_json(F.struct(F.lit("events").alias("source"), F.lit("equity").alias("asset_class"),
                                  F.col("event_type").alias("symbol"), F.lit(key).alias("dedup_key"),
                                  headline.alias("headline")))

    first = record("a", F.col("props"))
    second = record("b", F.lit('x}{"source":y"'))
    cut = F.substr(second, F.lit(1), F.length(second) - 9)
    i = F.col("event_id") % 5
    line = F.concat(F.when(i == 1, F.lit('junk " ')).otherwise(F.lit("")), first,
                    F.when(i == 2, cut).when(i == 3, F.lit(" ")).otherwise(F.lit("")), second)
    out = split_records(ev.select("event_id", line.alias("value")), S.RAW_ARCHIVE_DATA, keep=["event_id"])
    return out.select("event_id", "dedup_key", "symbol", "headline",
                      F.col(S.CORRUPT_COL).isNotNull().alias("bad"))


# News and ticks on one archive line, and a record of neither kind: typed by shape.
@register("s6_mixed_routes", """
SELECT event_id, 'ticks' AS kind, event_type AS symbol, CAST(value AS DOUBLE) AS price,
       epoch_us(ts) // 1000 AS timestamp_ms, NULL AS headline, event_id % 3 AS n_conditions, NULL AS record
FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, 'news', event_type, NULL, NULL, props, NULL, NULL FROM events WHERE event_id % 3 <> 0
UNION ALL SELECT event_id, 'other', NULL, NULL, NULL, NULL, NULL,
       '{"source":"events","asset_class":"fx","symbol":"' || event_type || '"}' FROM events WHERE event_id % 7 = 0
UNION ALL SELECT event_id, 'bad', NULL, NULL, NULL, NULL, NULL, 'ping ' || event_id FROM events WHERE event_id % 5 = 1
""", ("S6", "S8"))
def q_s6_mixed_routes(spark, sf_dir):
    from ..sources.archive import route_records
    ev = V.table(spark, sf_dir, "events")
    i, blank = F.col("event_id"), F.lit("")

    def record(kind, *fields):
        return F.to_json(F.struct(F.lit("events").alias("source"), F.lit(kind).alias("asset_class"),
                                  F.col("event_type").alias("symbol"), *fields))

    marks = F.slice(F.array(F.lit("1"), F.lit("12")), F.lit(1), (i % 3).cast("int"))
    tick = record("equity", F.col("value").alias("price"), timecols.ntz_to_epoch_millis("ts").alias("timestamp_ms"),
                  marks.alias("conditions"))
    news = record("equity", F.col("props").alias("headline"))
    line = F.concat(F.when(i % 5 == 1, F.concat(F.lit("ping "), i.cast("string"))).otherwise(blank),
                    F.when(i % 2 == 0, tick).otherwise(blank), F.when(i % 3 != 0, news).otherwise(blank),
                    F.when(i % 7 == 0, record("fx")).otherwise(blank))
    out = route_records(ev.select("event_id", line.alias("value")), keep=["event_id"])
    return out.select("event_id", "kind", "symbol", "price", "timestamp_ms", "headline",
                      F.when(F.col("kind") == "ticks", F.size("conditions")).cast("bigint").alias("n_conditions"),
                      "record")


# ---------------------------------------------------------- encoded anomalies
@register("p19_base64_decode", """
SELECT event_id, event_id % 7 NOT IN (1, 2, 3) AS ok,
       CASE WHEN event_id % 7 NOT IN (1, 2, 3) THEN event_type END AS symbol,
       CASE WHEN event_id % 7 NOT IN (1, 2, 3) THEN event_id END AS event_count,
       CASE WHEN event_id % 7 NOT IN (1, 2, 3)
            THEN event_type || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') END AS dedup_key
FROM events""", ("P19", "S9", "P15", "W8"))
def q_p19_base64_decode(spark, sf_dir):
    from ..streaming.alerter import decode
    ev = V.table(spark, sf_dir, "events")
    i = F.col("event_id") % 7
    text = F.to_json(F.struct(F.col("event_type").alias("symbol"),
                              F.date_format("ts", keys.ALERT_TS_FORMAT).alias("window_start"),
                              F.col("event_id").alias("event_count")))
    text = (F.when(i == 2, F.concat(F.lit("["), text, F.lit("]")))
             .when(i == 3, F.substr(text, F.lit(1), F.length(text) - 4)).otherwise(text))
    data = F.when(i == 1, F.lit("!!not base64!!")).otherwise(F.base64(text.cast("binary")))
    out = decode(ev.select("event_id", data.alias("data")))
    key = F.when(F.col("ok"), keys.alert_key("symbol", "window_start", window_start_is_text=True))
    return out.select("event_id", "ok", F.when(F.col("ok"), F.col("symbol")).alias("symbol"),
                      F.when(F.col("ok"), F.col("event_count")).alias("event_count"), key.alias("dedup_key"))


# ------------------------------------------------------------- relay messages
@register("p14_ticks", """
WITH m AS (SELECT event_id, CASE WHEN event_id % 9 = 2 THEN 'UNKNOWN' ELSE event_type END AS symbol,
                  CASE WHEN event_id % 7 = 1 THEN 'abc' ELSE CAST(value AS VARCHAR) END AS p,
                  CAST(event_id * 1000000 AS VARCHAR) AS v, epoch_us(ts) // 1000 AS t
           FROM events WHERE event_id % 5 <> 0)
SELECT symbol, TRY_CAST(p AS DOUBLE) AS price, CAST(v AS DOUBLE) AS volume, t AS timestamp_ms,
       CAST(CASE WHEN event_id % 8 = 3 THEN 2 ELSE 0 END AS INTEGER) AS n_conditions,
       substr(sha256(symbol || '|' || CAST(t AS VARCHAR) || '|' || p || '|' || v), 1, 16) AS dedup_key
FROM m""", ("P14", "P12", "P10", "F2"))
def q_p14_ticks(spark, sf_dir):
    from ..operators.normalize import normalize_ticks
    ev = V.table(spark, sf_dir, "events")
    i = F.col("event_id")
    price = F.when(i % 7 == 1, F.lit('"abc"')).otherwise(F.col("value").cast("string"))
    fields = F.concat_ws(", ", F.when(i % 9 != 2, F.concat(F.lit('"s": "'), F.col("event_type"), F.lit('"'))),
                         F.concat(F.lit('"p": '), price),
                         F.concat(F.lit('"v": '), (i * 1000000).cast("string")),
                         F.concat(F.lit('"t": '), timecols.ntz_to_epoch_millis("ts").cast("string")),
                         F.when(i % 8 == 3, F.lit('"c": ["1", "2"]')))
    text = F.when(i % 5 == 0, F.lit('{"type": "ping"}')).otherwise(
        F.concat(F.lit('{"type": "trade", "data": [{'), fields, F.lit("}]}")))
    out = normalize_ticks(ev.select(text.alias("value")), fetched_at=F.lit("x"))
    return out.select("symbol", "price", "volume", "timestamp_ms", F.size("conditions").alias("n_conditions"),
                      "dedup_key")


# --------------------------------------------------------------- daily series
@register("f4_payload_status", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'rate_limited' WHEN 2 THEN 'rate_limited'
                 ELSE 'unexpected' END AS status,
       CAST(CASE WHEN event_id % 4 = 0 THEN 2 ELSE 0 END AS BIGINT) AS n_bars
FROM events""", ("F4", "S10", "P13"))
def q_f4_payload_status(spark, sf_dir):
    from ..operators.normalize import classify_payloads
    from ..sources.raw import parse_daily_series
    i = F.col("event_id") % 4
    bar = '{"1. open": "1.0", "2. high": "2", "3. low": "0.5", "4. close": "1.5", "5. volume": "9"}'
    text = (F.when(i == 0, F.lit(f'{{"Time Series (Daily)": {{"2024-01-02": {bar}, "2024-01-03": {bar}}}}}'))
             .when(i == 1, F.lit('{"Note": "slow down"}')).when(i == 2, F.lit('{"Information": "limit"}'))
             .when(F.col("event_id") % 8 == 3, F.lit('{"Error": ')).otherwise(F.lit('{"Error": "?"}')))
    ev = V.table(spark, sf_dir, "events").select("event_id", text.alias("payload_text"))
    out = classify_payloads(parse_daily_series(ev))
    series = F.col("payload")["Time Series (Daily)"]
    return out.select("event_id", "status",
                      F.when(series.isNotNull(), F.size(series)).otherwise(0).cast("bigint").alias("n_bars"))


# ----------------------------------------------------------- news envelope
@register("p11_news_envelope", """
SELECT CASE WHEN event_id % 3 = 0 THEN 'Publisher' ELSE 'finnhub' END AS source, 'equity' AS asset_class,
       event_type AS symbol,
       substr(sha256(event_type || '|' || CASE WHEN event_id % 4 = 1 THEN '0'
              ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) END || '|' ||
              CASE WHEN event_id % 6 = 2 THEN '' ELSE CAST(user_id AS VARCHAR) END), 1, 16) AS dedup_key,
       event_id AS id
FROM events""", ("P11", "P9"))
def q_p11_news_envelope(spark, sf_dir):
    from ..operators.normalize import normalize_news
    i = F.col("event_id")
    ev = V.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("request_symbol"), i.alias("id"),
        F.when(i % 4 != 1, timecols.to_epoch_seconds("ts")).alias("datetime"),
        F.when(i % 6 != 2, F.col("user_id").cast("string")).alias("url"),
        F.when(i % 3 == 0, F.lit("Publisher")).alias("source"))
    return normalize_news(ev, fetched_at=F.lit("x")).select("source", "asset_class", "symbol", "dedup_key", "id")


# ------------------------------------------------------- first seen and expiry
@register("p20_first_seen_and_ttl", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS first_seen,
       epoch_us(ts) // 1000000 + 30 * 86400 AS ttl
FROM events""", ("P20",))
def q_p20_first_seen_and_ttl(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    at = F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts")))
    return ev.select("event_id", timecols.iso_utc(at).alias("first_seen"), timecols.ttl_epoch(at).alias("ttl"))


# ------------------------------------------------------------ nested payloads
@register("p13_flatten_payload", """
SELECT event_id, unnest(map_keys(m)) AS field, unnest(map_values(m)) AS value
FROM (SELECT event_id, CAST(props::JSON AS MAP(VARCHAR, BIGINT)) AS m FROM events)""", ("P13",))
def q_p13_flatten_payload(spark, sf_dir):
    from ..operators.normalize import flatten_map
    ev = V.table(spark, sf_dir, "events").select("event_id", "props")
    return flatten_map(ev, "props", "map<string,bigint>", ["event_id"], "field", "value")

# The extension queries register themselves into REGISTRY on import.
from . import extensions as _extensions  # noqa: E402,F401
