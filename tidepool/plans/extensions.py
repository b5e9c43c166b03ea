"""Extension queries (X1–X19) over the driver tables, with DuckDB oracles.

The reference only *names* these (bars bronze, OHLC, signals, as-of, sector
rollups, CDC, quality, silver/gold); every definition here is ours and is
labelled an extension.  Mapping to the driver tables is in
``driver_views`` and FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys
from ..operators import cdc, gold, quality, signals
from ..operators.joins import asof_join
from . import driver_views as V
from .registry import ART_KEY, DAY, _anomalies, _tumble_sql, register

# ------------------------------------------------------------ SQL pieces
TICKS_CTE = """ticks AS (SELECT event_type AS symbol, ts, event_id, value AS price,
                       CAST(props ->> '$.k' AS BIGINT) AS volume FROM events)"""
BARS_CTE = TICKS_CTE + """,
bars AS (SELECT symbol, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
                arg_min(price, {'t': ts, 'i': event_id}) AS open, max(price) AS high,
                min(price) AS low, arg_max(price, {'t': ts, 'i': event_id}) AS close,
                CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n_trades
         FROM ticks GROUP BY symbol, time_bucket(INTERVAL 1 HOUR, ts))"""
W = "OVER (PARTITION BY symbol ORDER BY window_start"
DIM_SQL = """(SELECT s_suppkey, n_name, r_name FROM supplier
              JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

BAR_WIDTH = "1 hour"


def _bars(spark, sf_dir):
    return signals.ohlc_bars(V.ticks(spark, sf_dir), BAR_WIDTH, tiebreak="event_id")


# ------------------------------------------------------------------ X1
X1_SQL = """
WITH raw AS (
  SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS date, value AS c, event_id,
         props ->> '$.k' AS vol, ts AS fetched_at,
         substr(sha256(event_type || '|' || strftime(ts, '%Y-%m-%d')), 1, 16) AS dedup_key
  FROM events)
SELECT symbol, dedup_key, CAST(TRY_CAST(date AS DATE) AS TIMESTAMP) AS bar_date,
       CASE WHEN event_id % 6 <> 1 THEN c - 1 END AS open, c + 2.5 AS high, c - 2.5 AS low, c AS close,
       CASE WHEN event_id % 5 <> 2 THEN TRY_CAST(vol AS BIGINT) END AS volume, 'events' AS source,
       CAST(year(CAST(date AS DATE)) AS INTEGER) AS event_year,
       CAST(month(CAST(date AS DATE)) AS INTEGER) AS event_month
FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key, symbol, date
                                   ORDER BY fetched_at DESC, event_id DESC) rn FROM raw) WHERE rn = 1"""


@register("x1_bars_bronze", X1_SQL, ("X1", "P8", "D3"))
def q_x1_bars_bronze(spark, sf_dir):
    from ..operators.bronze import bronze_bars
    ev = V.table(spark, sf_dir, "events")
    c, i = F.col("value"), F.col("event_id")
    day = F.date_format("ts", "yyyy-MM-dd")
    # all text, as in the raw zone; some numbers are damaged and become null
    raw = ev.select(F.lit("events").alias("source"), F.col("event_type").alias("symbol"), day.alias("date"),
                    F.when(i % 6 == 1, "12x").otherwise((c - 1).cast("string")).alias("open"),
                    (c + 2.5).cast("string").alias("high"), (c - 2.5).cast("string").alias("low"),
                    c.cast("string").alias("close"),
                    F.when(i % 5 == 2, "none").otherwise(F.get_json_object("props", "$.k")).alias("volume"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("fetched_at"), i.alias("id"),
                    keys.bar_key(F.col("event_type"), day).alias("dedup_key"))
    out = bronze_bars(raw)
    # the bar date is shown as its midnight (timestamp_ntz), the type the checks compare
    return out.drop("_ingestion_ts", "_pipeline").withColumn("bar_date", F.col("bar_date").cast("timestamp_ntz"))


# ------------------------------------------------------------------ X2
@register("x2_ohlc_1h", f"WITH {BARS_CTE} SELECT * FROM bars", ("X2",))
def q_x2_ohlc(spark, sf_dir):
    return _bars(spark, sf_dir)


# ------------------------------------------------------------- X3 – X7
@register("x3_volume_spike", f"""
WITH {BARS_CTE}
SELECT symbol, window_start, volume,
       round(avg(volume) {W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS avg_prev_volume,
       COALESCE(volume > 2.0 * avg(volume) {W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), false)
         AS is_spike
FROM bars""", ("X3",))
def q_x3_volume_spike(spark, sf_dir):
    out = signals.volume_spike(_bars(spark, sf_dir), n=5, k=2.0)
    return out.select("symbol", "window_start", "volume",
                      F.round("avg_prev_volume", 6).alias("avg_prev_volume"), "is_spike")


@register("x4_gap", f"""
WITH {BARS_CTE}, g AS (
  SELECT symbol, window_start, open,
         CASE WHEN lag(close) {W}) <> 0 THEN open / lag(close) {W}) END - 1 AS gap FROM bars)
SELECT symbol, window_start, open, round(gap, 6) AS gap, COALESCE(abs(gap) > 0.5, false) AS is_gap
FROM g""", ("X4",))
def q_x4_gap(spark, sf_dir):
    out = signals.gap(_bars(spark, sf_dir), limit=0.5)
    return out.select("symbol", "window_start", "open", F.round("gap", 6).alias("gap"), "is_gap")


@register("x5_momentum", f"""
WITH {BARS_CTE}
SELECT symbol, window_start, close,
       round(CASE WHEN lag(close, 3) {W}) <> 0 THEN close / lag(close, 3) {W}) END - 1, 6)
         AS momentum
FROM bars""", ("X5",))
def q_x5_momentum(spark, sf_dir):
    out = signals.momentum(_bars(spark, sf_dir), n=3)
    return out.select("symbol", "window_start", "close", F.round("momentum", 6).alias("momentum"))


@register("x6_volatility_regime", f"""
WITH {BARS_CTE},
r AS (SELECT symbol, window_start,
             ln(CASE WHEN lag(close) {W}) <> 0 THEN close / lag(close) {W}) END) AS log_return
      FROM bars),
v AS (SELECT *, stddev_samp(log_return) {W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS volatility
      FROM r)
SELECT symbol, window_start, round(log_return, 6) AS log_return, round(volatility, 6) AS volatility,
       CASE WHEN volatility IS NULL THEN 'unknown' WHEN volatility < 0.5 THEN 'low'
            WHEN volatility < 1.0 THEN 'normal' ELSE 'high' END AS regime
FROM v""", ("X6",))
def q_x6_volatility(spark, sf_dir):
    out = signals.volatility_regime(_bars(spark, sf_dir), n=6)
    return out.select("symbol", "window_start", F.round("log_return", 6).alias("log_return"),
                      F.round("volatility", 6).alias("volatility"), "regime")


@register("x7_zscore", f"""
WITH {BARS_CTE},
s AS (SELECT symbol, window_start, n_trades,
             avg(n_trades) {W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS mu,
             stddev_samp(n_trades) {W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS sd
      FROM bars)
SELECT symbol, window_start, n_trades,
       round(CASE WHEN sd > 0 THEN (n_trades - mu) / sd END, 6) AS zscore
FROM s""", ("X7",))
def q_x7_zscore(spark, sf_dir):
    out = signals.zscore(_bars(spark, sf_dir), "n_trades", n=10)
    return out.select("symbol", "window_start", "n_trades", F.round("zscore", 6).alias("zscore"))


# ------------------------------------------------------------------ X8
@register("x8_latest_quote", f"""
WITH {TICKS_CTE}
SELECT symbol, ts, event_id, price, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) rn FROM ticks)
WHERE rn = 1""", ("X8",))
def q_x8_latest_quote(spark, sf_dir):
    return signals.latest_quote(V.ticks(spark, sf_dir), tiebreak="event_id")


# ------------------------------------------------------------------ X9
def _supplier_dim(spark, sf_dir):
    """supplier → nation → region, by plain joins (Spark picks broadcasts by bytes)."""
    sup = V.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = V.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = V.table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
               .join(reg, F.col("n_regionkey") == reg.r_regionkey)
               .select("s_suppkey", "n_name", "r_name"))


@register("x9_sector_lookup", f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, COALESCE(d.r_name, 'UNKNOWN') AS sector
FROM lineitem l LEFT JOIN {DIM_SQL} d ON l.l_suppkey = d.s_suppkey""", ("X9",))
def q_x9_sector_lookup(spark, sf_dir):
    li = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    dim = _supplier_dim(spark, sf_dir).select(F.col("s_suppkey").alias("l_suppkey"),
                                               F.col("r_name").alias("sector"))
    return gold.sector_lookup(li, dim, "l_suppkey")


@register("x9_sector_as_of", f"""
WITH c AS ({V.SECTOR_CHANGES_SQL}),
v AS (SELECT *, lead(since) OVER (PARTITION BY s_suppkey ORDER BY since, j) AS till FROM c)
SELECT l_orderkey, l_linenumber, l_suppkey, COALESCE(sector, 'UNKNOWN') AS sector
FROM lineitem LEFT JOIN v ON l_suppkey = s_suppkey AND NOT gone AND l_shipdate >= since
                         AND (till IS NULL OR l_shipdate < till)""", ("X9", "X14"))
def q_x9_sector_as_of(spark, sf_dir):
    li = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    out = gold.sector_as_of(li, V.sector_changes(spark, sf_dir), "l_suppkey", "l_shipdate", "since",
                            tiebreak=["j"], delete_flag="gone")
    return out.drop("l_shipdate")


# ----------------------------------------------------------------- X10
@register("x10_silver_conformed", f"""
WITH u AS (
  SELECT 'events' AS source, event_type AS symbol, {ART_KEY} AS dedup_key,
         event_type || '|' || CAST({DAY} AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) AS identity,
         ts AS fetched_ts, event_id AS item_id FROM events
  UNION ALL BY NAME
  SELECT source, upper(lang) AS symbol, substr(sha256(text), 1, 16) AS dedup_key, sha256(text) AS identity,
         doc_id AS item_id
  FROM documents)
SELECT source, symbol, dedup_key, item_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source, symbol, dedup_key, identity
                               ORDER BY fetched_ts DESC NULLS LAST, item_id DESC) rn FROM u)
WHERE rn = 1""", ("X10", "D3"))
def q_x10_silver(spark, sf_dir):
    """Silver as it grows: the articles are there, then a batch with the same
    articles again and the documents arrives, and only new keys are appended."""
    art = V.articles(spark, sf_dir).select(
        "source", "symbol", "dedup_key", F.concat_ws("|", "symbol", "datetime", "url").alias("identity"),
        "fetched_ts", F.col("id").alias("item_id"))
    digest = F.sha2("text", 256)
    docs = V.table(spark, sf_dir, "documents").select(
        "source", F.upper("lang").alias("symbol"), F.substring(digest, 1, 16).alias("dedup_key"),
        digest.alias("identity"), F.col("doc_id").alias("item_id"))
    order = ["fetched_ts", "item_id"]
    there = gold.silver_dedup(gold.conform_sources([art]), order)
    batch = gold.silver_dedup(gold.conform_sources([art, docs]), order)
    silver = gold.conform_sources([there, gold.append_new_keys(there, batch)])
    return silver.select("source", "symbol", "dedup_key", "item_id")


# ----------------------------------------------------------------- X11
X11_SQL = """
SELECT rule, CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed, failed = 0 AS passed
FROM (""" + """
SELECT 'orders.o_custkey not null' AS rule, count(*) AS checked,
       count(*) FILTER (WHERE o_custkey IS NULL) AS failed FROM orders
UNION ALL SELECT 'orders.o_orderkey unique', count(*), count(o_orderkey) - count(DISTINCT o_orderkey)
  FROM orders
UNION ALL SELECT 'orders.o_totalprice >= 0', count(*),
  count(*) FILTER (WHERE NOT COALESCE(o_totalprice >= 0, false)) FROM orders
UNION ALL SELECT 'orders.o_custkey in customer', count(*),
  count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL))
  FROM orders WHERE o_custkey IS NOT NULL
UNION ALL SELECT 'lineitem.l_discount in [0, 1]', count(*),
  count(*) FILTER (WHERE NOT COALESCE(l_discount >= 0 AND l_discount <= 1, false)) FROM lineitem
UNION ALL SELECT 'lineitem.l_quantity >= 1', count(*),
  count(*) FILTER (WHERE NOT COALESCE(l_quantity >= 1, false)) FROM lineitem
UNION ALL SELECT 'lineitem.l_partkey in part', count(*),
  count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL))
  FROM lineitem WHERE l_partkey IS NOT NULL) q"""


@register("x11_quality_rules", X11_SQL, ("X11",))
def q_x11_quality(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    li = V.table(spark, sf_dir, "lineitem")
    cust = V.table(spark, sf_dir, "customer")
    part = V.table(spark, sf_dir, "part")
    o = quality.check(orders, [
        quality.not_null("orders.o_custkey not null", "o_custkey"),
        quality.unique("orders.o_orderkey unique", "o_orderkey"),
        quality.in_range("orders.o_totalprice >= 0", "o_totalprice", lo=0),
        quality.references("orders.o_custkey in customer", "o_custkey", cust, "c_custkey")])
    li_rules = quality.check(li, [
        quality.in_range("lineitem.l_discount in [0, 1]", "l_discount", 0, 1),
        quality.in_range("lineitem.l_quantity >= 1", "l_quantity", lo=1),
        quality.references("lineitem.l_partkey in part", "l_partkey", part, "p_partkey")])
    return o.unionByName(li_rules)


# ----------------------------------------------------------------- X12
@register("x12_asof_view_before_purchase", """
WITH p AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'),
     v AS (SELECT user_id, ts AS view_ts, event_id AS view_event_id, value AS view_value
           FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.ts, v.view_event_id, v.view_ts, v.view_value
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts""", ("X12",))
def q_x12_asof(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    p = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = ev.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_event_id"),
        F.col("value").alias("view_value"))
    return asof_join(p, v, ["user_id"], "ts", "view_ts", ["view_event_id", "view_ts", "view_value"],
                     tiebreak=["view_event_id"])


X12_AS_OF = "1996-01-01 00:00:00"


@register("x12_snapshot_as_of", f"""
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
  FROM orders WHERE o_orderdate <= TIMESTAMP '{X12_AS_OF}') WHERE rn = 1""", ("X12",))
def q_x12_snapshot(spark, sf_dir):
    o = V.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return cdc.snapshot_as_of(o, ["o_custkey"], "o_orderdate", X12_AS_OF, ["o_orderkey"]) \
        .select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")


# ----------------------------------------------------------------- X13
@register("x13_sector_rollup", f"""
SELECT r_name AS sector, n_name AS symbol, CAST(GROUPING(r_name, n_name) AS BIGINT) AS gid,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS amount, sum(l_quantity) AS weight,
       count(*) AS n_rows,
       round(sum(l_extendedprice * (1 - l_discount)) / sum(l_quantity), 6) AS weighted_price
FROM lineitem JOIN {DIM_SQL} d ON l_suppkey = d.s_suppkey
GROUP BY ROLLUP (r_name, n_name)""", ("X13",))
def q_x13_rollup(spark, sf_dir):
    li = V.table(spark, sf_dir, "lineitem")
    # pre-aggregate the fact per supplier before joining the dimension
    per_sup = li.groupBy("l_suppkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
        F.sum("l_quantity").alias("weight"), F.count(F.lit(1)).alias("n"))
    dim = _supplier_dim(spark, sf_dir)
    j = per_sup.join(dim, per_sup.l_suppkey == dim.s_suppkey).select(
        F.col("r_name").alias("sector"), F.col("n_name").alias("symbol"), "amount", "weight", "n")
    out = gold.rollup_revenue(j, ["sector", "symbol"], "amount", "weight", "n")
    return out.select("sector", "symbol", "gid", F.round("amount", 2).alias("amount"), "weight",
                      "n_rows", F.round("weighted_price", 6).alias("weighted_price"))


# ----------------------------------------------------------------- X14
@register("x14_cdc_current_state", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
  FROM orders) WHERE rn = 1 AND o_orderstatus <> 'P'""", ("X14",))
def q_x14_current(spark, sf_dir):
    o = V.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority",
        (F.col("o_orderstatus") == "P").alias("is_delete"))
    return cdc.current_state(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "is_delete")


@register("x14_scd2_intervals", """
SELECT o_custkey, o_orderkey, o_orderdate AS valid_from,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL
         AS is_current
FROM orders""", ("X14",))
def q_x14_scd2(spark, sf_dir):
    o = V.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return cdc.scd2_intervals(o, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "valid_from", "valid_to", "is_current")


# ----------------------------------------------------------------- X15
@register("x15_delivery_compare", """
WITH d AS (SELECT o_orderkey AS orderkey, min(o_orderdate) AS dts FROM orders GROUP BY 1),
     s AS (SELECT l_orderkey AS orderkey, min(l_shipdate) AS sts FROM lineitem GROUP BY 1),
     j AS (SELECT CASE WHEN dts IS NOT NULL AND sts IS NOT NULL THEN 'both'
                       WHEN dts IS NOT NULL THEN 'only_direct' ELSE 'only_streamed' END AS status,
                  (epoch_us(sts) - epoch_us(dts)) // 1000000 AS lat
           FROM d FULL OUTER JOIN s USING (orderkey)),
r AS (SELECT *, count(*) OVER (PARTITION BY status, lat IS NULL ORDER BY lat) AS upto,
             count(*) OVER (PARTITION BY status, lat IS NULL) AS n FROM j)
SELECT status, count(*) AS n_records, min(lat) AS min_latency, round(avg(lat), 3) AS avg_latency,
       max(lat) AS max_latency, min(lat) FILTER (WHERE upto >= 0.5 * n) AS p50_latency,
       min(lat) FILTER (WHERE upto >= 0.9 * n) AS p90_latency
FROM r GROUP BY status""", ("X15",))
def q_x15_compare(spark, sf_dir):
    d = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    s = V.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_shipdate")
    cmp = gold.compare_deliveries(d, s, "orderkey", "o_orderdate", "l_shipdate")
    out = gold.delivery_summary(cmp)
    return out.withColumn("avg_latency", F.round("avg_latency", 3))


# ----------------------------------------------------------------- X17
@register("x17_gold_daily_anomalies", f"""
WITH a AS ({_tumble_sql("1 HOUR", 3)})
SELECT symbol, CAST(CAST(window_start AS DATE) AS TIMESTAMP) AS day, count(*) AS n_anomalies,
       max(event_count) AS max_event_count
FROM a GROUP BY symbol, CAST(CAST(window_start AS DATE) AS TIMESTAMP)""", ("X17", "A1", "F1"))
def q_x17_gold(spark, sf_dir):
    return gold.daily_anomalies(_anomalies(spark, sf_dir, "1 hour", 3))


# ----------------------------------------------------------------- X18
@register("x18_feature_table", f"""
WITH {BARS_CTE},
r AS (SELECT *, ln(CASE WHEN lag(close) {W}) <> 0 THEN close / lag(close) {W}) END) AS log_return FROM bars),
v AS (SELECT *, stddev_samp(log_return) {W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS volatility,
             avg(n_trades) {W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS mu,
             stddev_samp(n_trades) {W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS sd FROM r),
f AS (SELECT symbol, window_start AS bar_start, window_end AS bar_end,
             CASE WHEN lag(close, 3) {W}) <> 0 THEN close / lag(close, 3) {W}) END - 1 AS momentum,
             COALESCE(volume > 2.0 * avg(volume) {W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), false)
               AS is_spike,
             CASE WHEN lag(close) {W}) <> 0 THEN open / lag(close) {W}) END - 1 AS gap,
             volatility, CASE WHEN volatility IS NULL THEN 'unknown' WHEN volatility < 0.5 THEN 'low'
                              WHEN volatility < 1.0 THEN 'normal' ELSE 'high' END AS regime,
             CASE WHEN sd > 0 THEN (n_trades - mu) / sd END AS zscore
      FROM v)
SELECT t.event_id, t.symbol, t.ts, f.bar_start, round(f.momentum, 6) AS momentum, f.is_spike,
       round(f.gap, 6) AS gap, round(f.volatility, 6) AS volatility, f.regime, round(f.zscore, 6) AS zscore
FROM ticks t ASOF LEFT JOIN f ON t.symbol = f.symbol AND t.ts >= f.bar_end""", ("X18", "X12", "X3", "X4",
                                                                                  "X5", "X6", "X7"))
def q_x18_features(spark, sf_dir):
    bars = _bars(spark, sf_dir)
    feats = signals.zscore(signals.volatility_regime(signals.gap(
        signals.volume_spike(signals.momentum(bars, n=3), n=5, k=2.0)), n=6), "n_trades", n=10)
    out = signals.features_before(V.ticks(spark, sf_dir).select("event_id", "symbol", "ts"), feats,
                                  ["momentum", "is_spike", "gap", "volatility", "regime", "zscore"], BAR_WIDTH)
    return out.withColumns({c: F.round(c, 6) for c in ("momentum", "gap", "volatility", "zscore")})


# ----------------------------------------------------------------- X19
X19_SQL = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderkey % 4 = 0 THEN 'F' ELSE o_orderstatus END
         AS o_orderstatus,
       CASE WHEN o_orderstatus = 'P' OR o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END
         AS o_totalprice
FROM orders"""


@register("x19_merge", X19_SQL, ("X19",))
def q_x19_merge(spark, sf_dir):
    """Orders by status; the updates move keys between partitions and empty one."""
    import uuid

    from ..session import checkpoint_dir, reliable_checkpoint, remove_tree
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                                     F.lit(1).alias("seq"))
    moved = orders.where((F.col("o_orderstatus") == "P") | (F.col("o_orderkey") % 4 == 0)).withColumns(
        {"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1, "seq": F.lit(2)})
    path = f"{checkpoint_dir(spark).rstrip('/')}/orders_{uuid.uuid4().hex}"
    try:
        for changes in (orders, moved):
            cdc.merge_partitions(spark, path, changes, ["o_orderkey"], ["seq"], ["o_orderstatus"])
        out = reliable_checkpoint(spark.read.schema(orders.schema).parquet(path))
    finally:
        remove_tree(spark, path)
    return out.select("o_orderkey", "o_orderstatus", "o_totalprice")
