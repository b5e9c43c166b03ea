"""A skew-aware as-of join.

As-of join without a native operator
------------------------------------
For each left row: the right row with the greatest right time ``<=`` the
left time, same ``by`` key.  A single window over ``partitionBy(by)`` would
put a hot key (a symbol with a third of all ticks) into one task, so the
time axis is cut into buckets and the scan is done in two levels:

1. inside each (key, bucket): a window over the union of both sides,
   ``last(right, ignoreNulls)`` up to the current row;
2. across buckets: one row per (key, bucket) holding the bucket's last
   right row (a partial aggregate), and a window over those small rows
   carrying the last one from earlier buckets forward.

Rows whose bucket has no earlier right row take the carried value.  The
level-2 window sees (keys × buckets) rows — bounded by the time span, not
by the data volume — and level 1 is spread over (key, bucket) partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slots import SLOT_ROWS, dense_cuts, with_slots


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str,
              right_cols: Sequence[str], tiebreak: Sequence[str] = (), prefix: str = "",
              bucket_seconds: int = 86400, allow_equal: bool = True, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Left as-of join; returns ``left`` columns plus ``prefix + right_cols``.

    ``tiebreak`` orders right rows that share a time (greatest wins).
    ``allow_equal`` lets a right row with the same time match (``>=``).
    Time buckets with more than ``slot_rows`` rows of a key (both sides) are cut by
    density, so no task sorts more than about that.
    """
    by = list(by)
    rcols = list(dict.fromkeys([right_ts, *tiebreak, *right_cols]))
    payload = F.struct(*[F.col(c).alias(c) for c in rcols])
    r_side = 0 if allow_equal else 2
    lcols = left.columns
    L = left.select(*[F.col(c) for c in lcols],
                    *[F.col(k).alias(f"__by{i}") for i, k in enumerate(by)],
                    F.col(left_ts).alias("__t"), F.lit(1).alias("__side"),
                    F.lit(None).cast(payload_type(right, rcols)).alias("__r"))
    r_ok = F.col(right_ts).isNotNull()
    for k in by:
        r_ok = r_ok & F.col(k).isNotNull()
    R = right.where(r_ok).select(*[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in lcols],
                     *[F.col(k).alias(f"__by{i}") for i, k in enumerate(by)],
                     F.col(right_ts).alias("__t"), F.lit(r_side).alias("__side"),
                     payload.alias("__r"))
    bys = [f"__by{i}" for i in range(len(by))]
    times = L.select(*bys, "__t").unionByName(R.select(*bys, "__t"))
    cuts = dense_cuts(times, bys, "__t", bucket_seconds, slot_rows)
    both = with_slots(L.unionByName(R), cuts, bys, "__t", bucket_seconds)
    slot = [*bys, "__b", "__slot"]
    tb = [F.col(f"__r.{c}") for c in tiebreak]
    w1 = (Window.partitionBy(*slot).orderBy("__t", "__side", *tb)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = (both.withColumn("__local", F.last("__r", ignorenulls=True).over(w1))
                 .where(F.col("__side") == 1))
    # level 2: last right row per (key, bucket), carried across buckets
    last_in = (both.where(F.col("__side") != 1).groupBy(*slot)
                .agg(F.max(F.struct(F.col("__t").alias("__t"), *[c.alias(f"__tb{i}") for i, c in
                                                                 enumerate(tb)], F.col("__r")))
                     ["__r"].alias("__last")))
    # the slots that left rows ask for, and those that carry something; both from
    # partial aggregates over the inputs, not from the window's output
    asked = both.where(F.col("__side") == 1).select(*slot).distinct()
    slots = asked.unionByName(last_in.select(*slot)).distinct()
    w2 = (Window.partitionBy(*bys).orderBy("__b", "__slot")
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = (slots.join(last_in, slot, "left")
                  .withColumn("__carry", F.last("__last", ignorenulls=True).over(w2))
                  .select(*slot, "__carry"))
    joined = local.join(carry, slot, "left")
    best = F.coalesce(F.col("__local"), F.col("__carry"))
    return joined.select(*[F.col(c) for c in lcols],
                         *[best[c].alias(f"{prefix}{c}") for c in right_cols])


def payload_type(df: DataFrame, cols: Sequence[str]):
    from pyspark.sql.types import StructField, StructType
    return StructType([StructField(c, df.schema[c].dataType, True) for c in cols])


# Widths of the slot levels, as multiples of the finest: an interval goes to the
# finest level on which it covers at most SPAN slots, so it is few rows at any length.
SPAN = 64
LEVELS = (1, SPAN, SPAN * SPAN)


def interval_join(facts: DataFrame, versions: DataFrame, by: Sequence[str], ts_col: str, from_col: str,
                  to_col: str, cols: Sequence[str], slot_seconds: int = 86400) -> DataFrame:
    """Left interval join: ``facts`` columns plus ``cols`` of the version with
    ``from <= ts < to`` of the same key (``to`` null: still open).

    Validity is binned into time slots: a version becomes a row for each slot it
    covers, on a level of slots coarse enough that these are at most SPAN + 1, and
    an open one (or one longer than the coarsest level allows) a single row of its
    key.  Facts ask by equality on (key, level, slot), on their distinct (key,
    time) only, and the bound is checked on the pairs that meet.  All joins are
    plain equality joins, which adaptive execution splits where a key is hot.

    Where versions overlap a fact has a row for each, without any a row of nulls.
    Null keys and null times match nothing; empty intervals are no versions.
    """
    by, cols = list(by), list(cols)
    keys = [f"__by{i}" for i in range(len(by))]
    v = versions.where(F.col(from_col).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(from_col).alias("__from"),
        F.col(to_col).alias("__to"), F.struct(*[F.col(c) for c in cols]).alias("__v"))
    v = v.where(F.col("__to").isNull() | (F.col("__from") < F.col("__to")))

    def slot(ts, level):
        return F.floor(F.unix_timestamp(ts) / (slot_seconds * level)).cast("bigint")

    rows = F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).cast("bigint").alias("slot")))
    for n, level in reversed(list(enumerate(LEVELS))):
        first, last = slot(F.col("__from"), level), slot(F.col("__to"), level)
        covered = F.sequence(first, F.greatest(first, F.least(last, first + SPAN)))
        spread = F.arrays_zip(F.transform(covered, lambda s: F.lit(n)).alias("level"), covered.alias("slot"))
        rows = F.when(F.col("__to").isNotNull() & (last - first <= SPAN), spread).otherwise(rows)
    binned = v.withColumn("__bin", F.explode(rows)).select("*", "__bin.level", "__bin.slot").drop("__bin")

    asked = facts.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)],
                         F.col(ts_col).alias("__ts")).distinct()
    probes = F.array(*[F.struct(F.lit(n).alias("level"), slot(F.col("__ts"), level).alias("slot"))
                       for n, level in enumerate(LEVELS)],
                     F.struct(F.lit(-1).alias("level"), F.lit(0).cast("bigint").alias("slot")))
    probe = asked.withColumn("__bin", F.explode(probes)).select("*", "__bin.level", "__bin.slot").drop("__bin")
    met = (probe.join(binned, [*keys, "level", "slot"])
           .where((F.col("__from") <= F.col("__ts")) & (F.col("__to").isNull() | (F.col("__ts") < F.col("__to"))))
           .select(*keys, "__ts", "__v"))
    on = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, keys, strict=True)]
    joined = facts.join(met, [*on, F.col(ts_col) == F.col("__ts")], "left")
    return joined.select(*facts.columns, *[F.col(f"__v.{c}").alias(c) for c in cols])
