"""Change data capture and merges on plain Parquet — extension.

- Current state: the latest change per key by sequence, dropping keys whose
  latest change is a delete (grouped max over a struct: partial
  aggregation, so a hot key never lands whole in one task).
- SCD-2: each version valid from its own time until the next version's
  time (``lead`` per key).
- Merge into a partitioned Parquet table: plain Parquet has no MERGE, so
  the partitions the updates go to or come from are read, merged (latest per
  key) and written back with dynamic partition overwrite.  This is not ACID
  (see README).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedup import latest_per_key
from .slots import SLOT_ROWS, dense_cuts, same_keys, with_slots


def current_state(changes: DataFrame, keys: Sequence[str], order: Sequence[str],
                  delete_flag: str | None = None) -> DataFrame:
    """Apply a change log: latest change per key, deletes removed."""
    latest = latest_per_key(changes, list(keys), list(order))
    if delete_flag:
        latest = latest.where(~F.coalesce(F.col(delete_flag), F.lit(False))).drop(delete_flag)
    return latest


def next_in_sequence(df: DataFrame, keys: Sequence[str], ts_col: str,
                     tiebreak: Sequence[str] = (), bucket_seconds: int = 86400,
                     out_col: str = "next_ts", slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``lead(ts_col)`` per key in (time, tiebreak) order, without a per-key window.

    Level 1 is a window per (key, slot): time buckets, those with more than
    ``slot_rows`` rows cut by density.  The last row of a slot takes the first
    row of the key's next non-empty slot, found by a window over one row per
    (key, slot) (a partial aggregate).  A null key is a key like any other.
    """
    keys = list(keys)
    cuts = dense_cuts(df, keys, ts_col, bucket_seconds, slot_rows)
    x = with_slots(df, cuts, keys, ts_col, bucket_seconds)
    slot = [*keys, "__b", "__slot"]
    local = x.withColumn("__next", F.lead(ts_col).over(Window.partitionBy(*slot).orderBy(ts_col, *tiebreak)))
    firsts = x.groupBy(*slot).agg(F.min(ts_col).alias("__first"))
    w2 = Window.partitionBy(*keys).orderBy("__b", "__slot")
    following = firsts.withColumn("__after", F.lead("__first").over(w2)).drop("__first")
    out = same_keys(local, following, slot, "left")
    return (out.withColumn(out_col, F.coalesce(F.col("__next"), F.col("__after")))
               .drop("__b", "__slot", "__next", "__after"))


def scd2_intervals(changes: DataFrame, keys: Sequence[str], ts_col: str,
                   tiebreak: Sequence[str] = (), bucket_seconds: int = 86400,
                   delete_flag: str | None = None, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """SCD-2 rows with ``valid_from``/``valid_to`` (null = current) and
    ``is_current``.  Versions per key are ordered by (time, tiebreak); the next
    version is found with ``next_in_sequence`` (skew-safe), so of a key's versions,
    a null key's too, one is current.  With ``delete_flag`` a delete closes the
    interval before it and is no version itself: a deleted key has no current one."""
    nxt = next_in_sequence(changes, keys, ts_col, tiebreak, bucket_seconds, "valid_to", slot_rows)
    if delete_flag:
        nxt = nxt.where(~F.coalesce(F.col(delete_flag), F.lit(False))).drop(delete_flag)
    return (nxt.withColumn("valid_from", F.col(ts_col))
               .withColumn("is_current", F.col("valid_to").isNull()))


def snapshot_as_of(changes: DataFrame, keys: Sequence[str], ts_col: str, as_of,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """X12 snapshot: each key's latest row with ``ts_col <= as_of``."""
    before = changes.where(F.col(ts_col) <= F.lit(as_of).cast(changes.schema[ts_col].dataType))
    return latest_per_key(before, list(keys), [ts_col, *tiebreak])


def merge_partitions(spark, target_path: str, updates: DataFrame, keys: Sequence[str],
                     order: Sequence[str], partition_cols: Sequence[str]) -> None:
    """Upsert ``updates`` into a partitioned Parquet table.

    An update may move its key to another partition, so the partitions to
    rewrite are those of the updates and those that hold one of their keys now
    (a semi-join on the key columns).  They are merged (latest per key), kept
    in a scratch table below the shared checkpoint folder, since files can't be
    read and overwritten in one plan, and written back; a partition whose rows
    all moved away is removed.  If the job ends between the write and the removal, a
    moved key stands in both partitions; running the same updates again finds it
    there and removes it.  Null keys and null partition values count as
    equal.  Other partitions are neither read beyond their keys nor rewritten.
    """
    from ..session import checkpoint_dir, path_exists, remove_tree, remove_uri

    parts, keys = list(partition_cols), list(keys)

    def same(left: DataFrame, right: DataFrame, cols: list[str], how: str) -> DataFrame:
        renamed = right.select(*[F.col(c).alias(f"__j_{c}") for c in cols]).distinct()
        return left.join(renamed, [F.col(c).eqNullSafe(F.col(f"__j_{c}")) for c in cols], how)

    def write(df: DataFrame) -> None:
        (df.hint("rebalance", *parts).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(target_path))

    if not path_exists(spark, target_path):
        write(latest_per_key(updates, keys, list(order)))
        return
    target = spark.read.parquet(target_path)
    folder = F.regexp_replace(F.input_file_name(), "/[^/]*$", "")
    held = same(target.select(*dict.fromkeys([*keys, *parts])), updates, keys, "left_semi")
    touched = updates.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in parts]) \
        .unionByName(held.select(*parts))
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/merge_{uuid.uuid4().hex}"
    try:
        current = same(target.withColumn("__folder", folder), touched, parts, "left_semi")
        merged = latest_per_key(current.drop("__folder").unionByName(updates, allowMissingColumns=True),
                                keys, list(order))
        merged.write.parquet(scratch)
        merged = spark.read.schema(merged.schema).parquet(scratch)
        emptied = same(current, merged, parts, "left_anti").select("__folder").distinct()
        emptied.write.parquet(f"{scratch}_emptied")
        write(merged)
        # one folder at a time on the driver, which has to remove them
        for gone in spark.read.schema("__folder string").parquet(f"{scratch}_emptied").toLocalIterator():
            remove_uri(spark, gone[0])
    finally:
        remove_tree(spark, scratch)
        remove_tree(spark, f"{scratch}_emptied")
