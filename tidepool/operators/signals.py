"""Price and volume signals — extension.

The reference names these signals without defining them; the definitions
here are ours.

Ticks are first rolled up into OHLC bars per (symbol, window) with a
partial-aggregating ``groupBy`` (X2), so a hot symbol is reduced map-side.
The rolling signals then run over bars, ordered per symbol: the number of
bars per symbol is (time span / bar width), set by the calendar and not by
the tick volume, so a per-symbol window stays small even at 100 TB of ticks.
All windows use row frames (``rowsBetween``) so Spark evaluates them in a
single streaming pass over the sorted partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ohlc_bars(ticks: DataFrame, width: str = "1 hour", symbol_col: str = "symbol",
              ts_col: str = "ts", price_col: str = "price", volume_col: str = "volume",
              tiebreak: str | None = None) -> DataFrame:
    """open/high/low/close/volume per tumbling window and symbol.

    Open and close are the first and last trade by (time, tiebreak).
    """
    order = F.struct(F.col(ts_col), F.col(tiebreak)) if tiebreak else F.col(ts_col)
    return (ticks.groupBy(F.window(ts_col, width).alias("w"), F.col(symbol_col).alias("symbol"))
                 .agg(F.min_by(price_col, order).alias("open"), F.max(price_col).alias("high"),
                      F.min(price_col).alias("low"), F.max_by(price_col, order).alias("close"),
                      F.sum(volume_col).cast("bigint").alias("volume"),
                      F.count(F.lit(1)).alias("n_trades"))
                 .select("symbol", F.col("w.start").alias("window_start"),
                         F.col("w.end").alias("window_end"),
                         "open", "high", "low", "close", "volume", "n_trades"))


def _w(symbol_col: str, ts_col: str) -> Window:
    return Window.partitionBy(symbol_col).orderBy(ts_col)


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def volume_spike(bars: DataFrame, n: int = 5, k: float = 2.0, symbol_col: str = "symbol",
                 ts_col: str = "window_start", volume_col: str = "volume") -> DataFrame:
    """``volume > k × mean(volume of the previous n bars)``."""
    prev = F.avg(volume_col).over(_w(symbol_col, ts_col).rowsBetween(-n, -1))
    return (bars.withColumn("avg_prev_volume", prev)
                .withColumn("is_spike", F.coalesce(F.col(volume_col) > F.lit(k) *
                                                   F.col("avg_prev_volume"), F.lit(False))))


def gap(bars: DataFrame, limit: float = 0.5, symbol_col: str = "symbol",
        ts_col: str = "window_start") -> DataFrame:
    """``open / previous close − 1``; ``is_gap`` when its size exceeds ``limit``."""
    prev_close = F.lag("close").over(_w(symbol_col, ts_col))
    g = _safe_div(F.col("open"), prev_close) - 1
    return (bars.withColumn("gap", g)
                .withColumn("is_gap", F.coalesce(F.abs(F.col("gap")) > F.lit(limit), F.lit(False))))


def momentum(bars: DataFrame, n: int = 3, symbol_col: str = "symbol",
             ts_col: str = "window_start") -> DataFrame:
    """``close / close n bars back − 1``."""
    back = F.lag("close", n).over(_w(symbol_col, ts_col))
    return bars.withColumn("momentum", _safe_div(F.col("close"), back) - 1)


# Fixed limits of the volatility regimes (ours).
VOL_LIMITS = (0.5, 1.0)


def volatility_regime(bars: DataFrame, n: int = 6, limits=VOL_LIMITS, symbol_col: str = "symbol",
                      ts_col: str = "window_start") -> DataFrame:
    """Rolling sample stddev of log returns over ``n`` bars, bucketed.

    ``low`` below the first limit, ``normal`` below the second, else
    ``high``; ``unknown`` until there are two returns.
    """
    w = _w(symbol_col, ts_col)
    ret = F.ln(_safe_div(F.col("close"), F.lag("close").over(w)))
    out = bars.withColumn("log_return", ret)
    vol = F.stddev_samp("log_return").over(w.rowsBetween(-(n - 1), 0))
    out = out.withColumn("volatility", vol)
    regime = (F.when(F.col("volatility").isNull(), F.lit("unknown"))
               .when(F.col("volatility") < limits[0], F.lit("low"))
               .when(F.col("volatility") < limits[1], F.lit("normal"))
               .otherwise(F.lit("high")))
    return out.withColumn("regime", regime)


def zscore(bars: DataFrame, value_col: str, n: int = 10, symbol_col: str = "symbol",
           ts_col: str = "window_start", out_col: str = "zscore") -> DataFrame:
    """Z-score of ``value_col`` against the previous ``n`` bars.

    The reference has no sentiment field; any numeric column can be scored.
    """
    w = _w(symbol_col, ts_col).rowsBetween(-n, -1)
    mu, sd = F.avg(value_col).over(w), F.stddev_samp(value_col).over(w)
    return bars.withColumn(out_col, F.when(sd > 0, (F.col(value_col) - mu) / sd))


def latest_quote(ticks: DataFrame, symbol_col: str = "symbol", ts_col: str = "ts",
                 tiebreak: str | None = None, cols=("price", "volume")) -> DataFrame:
    """The last tick per symbol (``max`` over a struct led by time)."""
    order = [F.col(ts_col).alias("__t")] + ([F.col(tiebreak).alias("__tb")] if tiebreak else [])
    keep = [c for c in (ts_col, *( [tiebreak] if tiebreak else []), *cols)]
    best = F.max(F.struct(*order, *[F.col(c) for c in dict.fromkeys(keep)])).alias("q")
    return ticks.groupBy(F.col(symbol_col).alias("symbol")).agg(best).select(
        "symbol", *[F.col(f"q.{c}").alias(c) for c in dict.fromkeys(keep)])


def features_before(ticks: DataFrame, bars: DataFrame, features: list[str], width: str = "1 hour",
                    symbol_col: str = "symbol", ts_col: str = "ts") -> DataFrame:
    """Each tick with the features of the last bar that had ended by then.

    Bars start on the width's grid, so all ticks of one (symbol, slot) share the
    answer: the bar before their own.  It is carried forward on the bars (few:
    set by the calendar), and the ticks meet it in one equality join on (symbol,
    slot), which Spark broadcasts while the bars' bytes allow it; no tick is
    windowed.  Returns the tick columns, ``bar_start`` and the features.
    """
    slot = F.window(F.col(ts_col), width)["start"]
    carried = F.lag(F.struct(F.col("window_start").alias("bar_start"), *features)).over(_w("symbol", "window_start"))
    answers = bars.select(F.col("symbol").alias("__symbol"), F.col("window_start").alias("__slot"),
                          carried.alias("__f"))
    joined = ticks.withColumn("__at", slot).join(
        answers, F.col(symbol_col).eqNullSafe(F.col("__symbol")) & (F.col("__at") == F.col("__slot")), "left")
    return joined.select(*ticks.columns, "__f.bar_start", *[F.col(f"__f.{c}").alias(c) for c in features])
