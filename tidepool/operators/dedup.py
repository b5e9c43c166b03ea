"""Deduplication.

Scale notes
- "Latest per key" is a grouped ``max(struct(order..., payload...))``, not
  a ``row_number`` window: the aggregate has a map-side partial step
  (planned as partial + final sort aggregates, the buffer being a struct),
  so a key holding a third of all rows is reduced to one row per input task
  before anything is shuffled, and no task ever sorts a whole key group.
- First-seen-with-expiry (D4) is a greedy chain per key (an emission
  blocks the key for the TTL, the next arrival after that re-emits).  It
  is computed as one time-ordered pass over TTL-wide buckets (see
  ``first_seen_with_ttl``): linear in the data, one small join per bucket,
  every round written to the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, reliable_checkpoint, remove_tree


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _pick_per_key(df: DataFrame, keys, order: Sequence, pick) -> DataFrame:
    keys = _names(keys)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    payload = [c for c in df.columns if c not in keys]
    ordered = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order_cols)],
                       *[F.col(c) for c in payload])
    return (df.groupBy(*keys).agg(pick(ordered).alias("__best"))
              .select(*keys, *[F.col(f"__best.{c}").alias(c) for c in payload]))


def latest_per_key(df: DataFrame, keys, order: Sequence) -> DataFrame:
    """D3: the row with the greatest ``order`` tuple per key.

    Equivalent to ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC
    NULLS LAST) = 1``; include a unique column last in ``order`` to make the
    survivor deterministic.
    """
    return _pick_per_key(df, keys, order, F.max)


def earliest_per_key(df: DataFrame, keys, order: Sequence) -> DataFrame:
    """D3 (ascending): the row with the smallest non-null ``order`` tuple per key."""
    return _pick_per_key(df, keys, order, F.min)


def dedup_by_key(df: DataFrame, keys, order: Sequence | None = None) -> DataFrame:
    """One row per key (null keys are equal to each other).

    Without ``order`` this is ``dropDuplicates`` (arbitrary survivor, like the
    reference); with ``order`` the survivor is the latest (D3).
    """
    if order is None:
        return df.dropDuplicates(_names(keys))
    return latest_per_key(df, keys, order)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``SELECT DISTINCT cols`` (partial aggregate before the shuffle)."""
    return (df.select(*cols) if cols else df).distinct()


def copies_per_key(df: DataFrame, keys) -> DataFrame:
    """D1 report: how many rows share each key."""
    return df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias("n_copies"))


def first_seen_with_ttl(df: DataFrame, keys, time_col: str, ttl_seconds: int,
                        order: Sequence | None = None) -> DataFrame:
    """D4 (batch): emit a record iff its key is unseen or its entry expired.

    An emission at ``t`` stores the key until ``t + ttl``; the first arrival
    at or after that re-emits.  Returns the emitted rows (the earliest record
    at each emission time, ties by ``order``) plus ``first_seen`` and
    ``expires_at`` (epoch seconds, the stored item's ``ttl``).

    A record without a time has no place in the order; the first such record
    of a key (by ``order``) is emitted once, with null ``first_seen`` and
    ``expires_at``, and neither blocks the key nor is blocked.

    One aggregate settles every key whose arrivals span less than the TTL: it
    emits its earliest.  For the others, emissions are at least one TTL apart,
    so with time cut into TTL-wide buckets a key emits at most once per bucket,
    and its emission in bucket ``b`` depends only on its emission in ``b-1``:
    arrivals before that emission + TTL are suppressed; with no emission in
    ``b-1`` the first arrival in ``b`` is emitted.  Their distinct (key, arrival)
    rows are written to scratch in the shared checkpoint folder, clustered by
    bucket, and the buckets are processed in time order, each round reading only
    its own bucket and the last round's emissions.  The number of rounds is set
    by the calendar, not by the volume.  The emissions are checkpointed and the
    scratch is deleted before this returns.
    """
    keys = _names(keys)
    spark = df.sparkSession
    ttl = int(ttl_seconds)
    base = f"{checkpoint_dir(spark).rstrip('/')}/first_seen_{uuid.uuid4().hex}"
    step = F.expr(f"INTERVAL {ttl} SECONDS")
    timed = df.where(F.col(time_col).isNotNull()).select(*keys, F.col(time_col).alias("__t"))
    span = timed.groupBy(*keys).agg(F.min("__t").alias("__e"), F.max("__t").alias("__z"))
    settled = F.col("__z") < F.col("__e") + step
    long_keys = span.where(~settled).select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(keys)])
    on = [F.col(k).eqNullSafe(F.col(f"__p{i}")) for i, k in enumerate(keys)]
    arrivals = (timed.join(long_keys, on, "left_semi").distinct()
                     .withColumn("__b", F.floor(F.unix_timestamp("__t") / ttl).cast("bigint")))
    try:
        arrivals.hint("rebalance", "__b").write.partitionBy("__b").parquet(f"{base}/arrivals")
        stored = spark.read.schema(arrivals.schema).parquet(f"{base}/arrivals")
        buckets = sorted(r[0] for r in stored.select("__b").distinct().collect())  # one row a TTL
        emitted = span.where(settled).select(*keys, "__e")
        prev_bucket = None
        for b in buckets:
            cur = stored.where(F.col("__b") == F.lit(b)).drop("__b")
            if prev_bucket == b - 1:
                prev = spark.read.parquet(f"{base}/emitted/__b={prev_bucket}")
                p = prev.select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(keys)], "__e")
                cur = (cur.join(p, on, "left")
                          .where(F.col("__e").isNull() | (F.col("__t") >= F.col("__e") + step))
                          .select(*keys, "__t"))
            (cur.groupBy(*keys).agg(F.min("__t").alias("__e"))
                .write.parquet(f"{base}/emitted/__b={b}"))
            prev_bucket = b
        if buckets:
            emitted = emitted.unionByName(spark.read.parquet(f"{base}/emitted").select(*keys, "__e"))
        emitted = reliable_checkpoint(emitted)
    finally:
        remove_tree(spark, base)
    # Attach the record that arrived at each emission time (ties by order).
    e = emitted.select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(keys)], "__e")
    hits = df.join(e, [*on, F.col(time_col) == F.col("__e")], "left_semi")
    hits = hits.unionByName(df.where(F.col(time_col).isNull()))
    tie = list(order) if order else [time_col]
    first = earliest_per_key(hits, [*keys, time_col], tie)
    return (first.withColumn("first_seen", F.col(time_col))
                 .withColumn("expires_at", F.unix_timestamp(F.col(time_col)) + F.lit(ttl)))


def first_seen_keys(df: DataFrame, seen: DataFrame, keys, time_col: str | None = None,
                    order: Sequence = ()) -> DataFrame:
    """D4 (batch, no expiry): records whose key is not in the ``seen`` table.

    With ``time_col`` only the earliest such record per key is kept (ties by
    ``order``), i.e. what a first-seen store would emit for this batch.
    """
    keys = _names(keys)
    fresh = df.join(seen.select(*keys).distinct(), keys, "left_anti")
    if time_col is None:
        return fresh
    return earliest_per_key(fresh, keys, [time_col, *order])
