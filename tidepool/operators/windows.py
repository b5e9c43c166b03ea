"""Event-time tumbling counts and the anomaly threshold (A1, F1).

``COUNT(*) GROUP BY window, symbol`` is a hash aggregate with a map-side
partial step, so a symbol that carries a third of all rows is pre-counted
in every input task before the shuffle: the shuffle moves one row per
(task, window, symbol), never the raw rows.  The same function runs on a
streaming DataFrame (with a watermark set upstream) and on a batch one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import THRESHOLD as DEFAULT_THRESHOLD
from ..fixed import WINDOW as DEFAULT_WINDOW


def tumbling_count(df: DataFrame, time_col: str = "published_at", key_col: str = "symbol",
                   width: str = DEFAULT_WINDOW, count_col: str = "event_count") -> DataFrame:
    """A1: ``COUNT(*)`` per tumbling event-time window and key.

    Rows with a null event time fall in no window and are dropped (Spark's
    ``window`` semantics); duplicates count again (``COUNT(*)``, not
    distinct keys).  Output: ``symbol, window_start, window_end, count``.
    """
    w = F.window(F.col(time_col), width)
    return (df.groupBy(w.alias("w"), F.col(key_col).alias("symbol"))
              .agg(F.count(F.lit(1)).alias(count_col))
              .select("symbol", F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), count_col))


def over_threshold(df: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                   count_col: str = "event_count") -> DataFrame:
    """keep windows whose count is ``>= threshold`` (the query, not the docstring)."""
    return df.where(F.col(count_col) >= F.lit(threshold))


def detect_anomalies(df: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                     width: str = DEFAULT_WINDOW, time_col: str = "published_at",
                     key_col: str = "symbol", detected_at=None) -> DataFrame:
    """A1 + F1 (+ P7): the detector's query.

    ``detected_at`` is a Column or literal; by default the micro-batch /
    query clock ``current_timestamp()``.  Pass ``False`` to leave it out
    (deterministic outputs for comparisons).
    """
    out = over_threshold(tumbling_count(df, time_col, key_col, width), threshold)
    if detected_at is False:
        return out
    clock = F.current_timestamp() if detected_at is None else detected_at
    return out.withColumn("detected_at", clock)
