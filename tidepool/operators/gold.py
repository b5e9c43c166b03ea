"""Silver and gold building blocks — extension.

Definitions are ours (the reference declares these layers but leaves them
empty).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cdc import scd2_intervals
from .dedup import latest_per_key
from .joins import interval_join

UNKNOWN_SECTOR = "UNKNOWN"


def sector_lookup(fact: DataFrame, dim: DataFrame, key: str, sector_col: str = "sector") -> DataFrame:
    """Attach a sector from a dimension; a missing sector is ``UNKNOWN``.

    A plain join: Spark broadcasts the dimension when its bytes allow it and
    shuffles otherwise, re-planned from real sizes at runtime.
    """
    return (fact.join(dim.select(key, sector_col), key, "left")
                .withColumn(sector_col, F.coalesce(F.col(sector_col), F.lit(UNKNOWN_SECTOR))))


def sector_as_of(fact: DataFrame, changes: DataFrame, key: str, ts_col: str, change_ts: str,
                 sector_col: str = "sector", tiebreak: Sequence[str] = (),
                 delete_flag: str | None = None) -> DataFrame:
    """X9 on X14: the sector that held at the fact's own time, from a change log.

    The log becomes SCD-2 intervals (a delete ends one) and the facts meet them in
    an interval join; before the first version, after a delete, and for keys
    without any, the sector is ``UNKNOWN``.
    """
    versions = scd2_intervals(changes, [key], change_ts, tiebreak, delete_flag=delete_flag)
    out = interval_join(fact, versions.select(key, "valid_from", "valid_to", sector_col), [key], ts_col,
                        "valid_from", "valid_to", [sector_col])
    return out.withColumn(sector_col, F.coalesce(F.col(sector_col), F.lit(UNKNOWN_SECTOR)))


def conform_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union news sources by column name (missing columns become null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


SILVER_KEY = ("source", "symbol", "dedup_key", "identity")


def silver_dedup(rows: DataFrame, order: Sequence[str], keys: Sequence[str] = SILVER_KEY) -> DataFrame:
    """Global latest-per-key.

    ``identity`` is the full content key (the fields or the whole digest that
    ``dedup_key`` was cut from): two records whose 64-bit keys collide stay apart.
    """
    return latest_per_key(rows, list(keys), list(order))


def append_new_keys(existing: DataFrame, incoming: DataFrame,
                    keys: Sequence[str] = SILVER_KEY) -> DataFrame:
    """Rows of ``incoming`` whose key is not yet in ``existing`` (to append);
    null key parts are equal to each other, so a replay appends nothing twice."""
    seen = existing.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return incoming.join(seen, same, "left_anti")


def rollup_revenue(df: DataFrame, levels: Sequence[str], amount: str, weight: str,
                   n_rows: str) -> DataFrame:
    """``rollup(levels...)`` of pre-aggregated amount, weight and row count, and
    the ratio, with ``grouping_id`` telling subtotal rows apart."""
    return (df.rollup(*levels)
              .agg(F.grouping_id().alias("gid"), F.sum(amount).alias("amount"),
                   F.sum(weight).alias("weight"), F.sum(n_rows).alias("n_rows"))
              .withColumn("weighted_price", F.when(F.col("weight") != 0,
                                                   F.col("amount") / F.col("weight"))))


def compare_deliveries(direct: DataFrame, streamed: DataFrame, key: str,
                       direct_ts: str, streamed_ts: str) -> DataFrame:
    """Full outer join of two deliveries of the same records.

    Each side is first reduced to one row per key (earliest arrival), so the
    join is one-to-one.  Returns ``status`` (both / only_direct /
    only_streamed) and ``latency_seconds`` for records on both sides.
    """
    d = direct.groupBy(key).agg(F.min(direct_ts).alias("__d"))
    s = streamed.groupBy(key).agg(F.min(streamed_ts).alias("__s"))
    j = d.join(s, key, "full_outer")
    status = (F.when(F.col("__d").isNotNull() & F.col("__s").isNotNull(), F.lit("both"))
               .when(F.col("__d").isNotNull(), F.lit("only_direct"))
               .otherwise(F.lit("only_streamed")))
    lat = F.unix_timestamp("__s") - F.unix_timestamp("__d")
    return j.select(key, status.alias("status"), lat.alias("latency_seconds"))


def delivery_summary(compared: DataFrame, shares=(0.5, 0.9)) -> DataFrame:
    """Per status: records, latency min/avg/max and exact percentiles.

    Latencies are whole seconds, so they are first counted per value (partial
    sums before the shuffle); a percentile is the smallest latency that at
    least that share of the records doesn't exceed, read off the running
    counts.  The window sees one row per distinct latency, not per record.
    """
    counted = compared.groupBy("status", "latency_seconds").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("latency_seconds").isNotNull()
    by = Window.partitionBy("status", known)
    upto = by.orderBy("latency_seconds").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = counted.withColumn("share", F.sum("n").over(upto) / F.sum("n").over(by))
    pick = [F.min(F.when(known & (F.col("share") >= q), F.col("latency_seconds")))
            .alias(f"p{round(q * 100)}_latency") for q in shares]
    total = F.sum(F.col("latency_seconds") * F.col("n"))
    return at.groupBy("status").agg(
        F.sum("n").alias("n_records"), F.min("latency_seconds").alias("min_latency"),
        (total / F.sum(F.when(known, F.col("n")))).alias("avg_latency"),
        F.max("latency_seconds").alias("max_latency"), *pick)


def daily_anomalies(anomalies: DataFrame) -> DataFrame:
    """Anomalies per symbol and day (count and largest window count).

    ``day`` is the day's start, in the type of ``window_start``."""
    day = F.to_date("window_start").cast(anomalies.schema["window_start"].dataType)
    return (anomalies.groupBy("symbol", day.alias("day"))
                     .agg(F.count(F.lit(1)).alias("n_anomalies"),
                          F.max("event_count").alias("max_event_count")))
