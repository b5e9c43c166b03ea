"""Time slots of bounded size: hot keys cut by measured density.

Windowed operators here never sort a whole key: they work within (key, time slot)
and carry one row per slot forward.  Fixed time buckets bound a slot by the
calendar only; a key with a third of all rows within one hour would still be one
sort.  So the rows of each (key, bucket) are counted first (partial sums), and
only where there are more than ``slot_rows`` they are counted again by fine cells
of time, and a new slot begins whenever the running count has passed another
``slot_rows``.  Sparse buckets stay whole, so
their rows meet nothing but a small table of cuts, and the number of slots grows
with the rows, not with the time span.

A slot holds about ``slot_rows`` rows, and at most as many more as its last cell
(a bucket's 65,536th: 1.3 seconds of a day) holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_ROWS = 100_000
CELLS = 1 << 16    # cells of a dense bucket

BUCKET, PART = "__b", "__slot"


def same_keys(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal ``cols``, null equal to null; the right side's copies of them go."""
    renamed = right.select(*[F.col(c).alias(f"__k_{c}") if c in cols else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in cols]
    return left.join(renamed, on, how).drop(*[f"__k_{c}" for c in cols])


def bucket(ts: Column, bucket_seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / bucket_seconds).cast("bigint")


def _micros(ts: Column, df: DataFrame, name: str) -> Column:
    """Microseconds in the order of ``ts``; a time without zone is never read in the session's."""
    kind = df.schema[name].dataType.typeName()
    if kind == "timestamp_ntz":
        since = ts - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        part = {u: F.extract(F.lit(u), since).cast("decimal(20,6)") for u in ("DAY", "HOUR", "MINUTE", "SECOND")}
        seconds = part["DAY"] * 86400 + part["HOUR"] * 3600 + part["MINUTE"] * 60 + part["SECOND"]
        return (seconds * 1_000_000).cast("bigint")
    return F.unix_micros(ts.cast("timestamp"))


def dense_cuts(rows: DataFrame, keys: Sequence[str], ts_col: str, bucket_seconds: int, slot_rows: int) -> DataFrame:
    """(keys, bucket, cuts) of the buckets that hold more than ``slot_rows`` rows;
    cuts: the ascending times (microseconds) at which a new slot begins.

    Counts alone decide, so every step of an operator, and every task that runs
    again, gets the same slots (a sketch's answer would depend on the order in
    which its parts arrive).
    """
    at = rows.select(*keys, bucket(F.col(ts_col), bucket_seconds).alias(BUCKET),
                     _micros(F.col(ts_col), rows, ts_col).alias("__us"))
    own = [*keys, BUCKET]
    dense = at.groupBy(*own).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > slot_rows)
    width = max(1, bucket_seconds * 1_000_000 // CELLS)
    timed = same_keys(at.where(F.col("__us").isNotNull()), dense.select(*own), own, "left_semi")
    counts = (timed.groupBy(*own, F.floor(F.col("__us") / width).alias("__cell"))
              .agg(F.count(F.lit(1)).alias("__n"), F.min("__us").alias("__lo")))
    # a row a cell that holds any: at most CELLS and one
    upto = Window.partitionBy(*own).orderBy("__lo").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counts.withColumn("__no", F.floor(F.coalesce(F.sum("__n").over(upto), F.lit(0)) / slot_rows))
    begins = numbered.groupBy(*own, "__no").agg(F.min("__lo").alias("__lo"))
    return (begins.where(F.col("__no") > 0).groupBy(*own)
            .agg(F.array_sort(F.collect_list("__lo")).alias("__cuts")))


def with_slots(rows: DataFrame, cuts: DataFrame, keys: Sequence[str], ts_col: str, bucket_seconds: int) -> DataFrame:
    """``rows`` with their slot: columns ``__b`` (bucket) and ``__slot`` (place of the
    cut before, 0 in a bucket without cuts); slots of a key are ordered by both."""
    placed = rows.withColumn(BUCKET, bucket(F.col(ts_col), bucket_seconds))
    us = _micros(F.col(ts_col), rows, ts_col)
    joined = same_keys(placed, cuts, [*keys, BUCKET], "left").withColumn("__us", us)
    before = F.size(F.filter("__cuts", lambda c: c <= F.col("__us")))
    return joined.withColumn(PART, F.when(F.col("__cuts").isNull() | F.col("__us").isNull(), F.lit(0))
                             .otherwise(before)).drop("__cuts", "__us")
