"""Record publishing: keyed stream records, anomaly records, dual writes,
alert sinks (K3, K4, K7, K8).

Delivery itself (a message broker, a mail topic) is outside the lake; these
functions shape the records and write them to file/table sinks idempotently
per micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import PUBLISH_CHUNK
from ..functions.keys import ALERT_TS_FORMAT, symbol_or_unknown
from ..operators.slots import SLOT_ROWS, dense_cuts, same_keys, with_slots


def keyed_records(df: DataFrame, symbol_col: str = "symbol", order_cols: Sequence[str] = (),
                  num_partitions: int | None = None) -> DataFrame:
    """K4: add the partition ``key`` (symbol, ``UNKNOWN`` when missing), with the
    records of a key together and in order.

    Rows are range-partitioned by key and order: the partitions of a key follow
    one another, each ordered, so a hot key is spread over many tasks and its
    order still stands.  Which broker partition a key belongs to is the
    sink's own hash of ``key``.
    """
    keyed = df.withColumn("key", symbol_or_unknown(F.col(symbol_col)))
    by = ["key", *order_cols]
    parts = keyed.repartitionByRange(num_partitions, *by) if num_partitions else keyed.repartitionByRange(*by)
    return parts.sortWithinPartitions(*by)


def publish_calls(keyed: DataFrame, ts_col: str, tiebreak: Sequence[str] = (), key_col: str = "key",
                  chunk: int = PUBLISH_CHUNK, bucket_seconds: int = 3600, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """K4: number the calls of ``chunk`` records that publish each key in order.

    Adds ``chunk_no`` (from 0).  A record's place within its key is its place in
    its (key, slot) plus the size of the key's earlier slots, so no window ever
    spans a whole key; time buckets with more than ``slot_rows`` records of a key
    are cut by density.
    """
    cuts = dense_cuts(keyed, [key_col], ts_col, bucket_seconds, slot_rows)
    rows = with_slots(keyed, cuts, [key_col], ts_col, bucket_seconds)
    slot = [key_col, "__b", "__slot"]
    sizes = rows.groupBy(*slot).agg(F.count(F.lit(1)).alias("__n"))
    earlier = (Window.partitionBy(key_col).orderBy(F.col("__b").asc_nulls_first(), "__slot")
               .rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    own = Window.partitionBy(*slot).orderBy(F.col(ts_col).asc_nulls_first(), *tiebreak)
    placed = same_keys(rows.withColumn("__at", F.row_number().over(own)), before, slot)
    no = F.floor((F.col("__before") + F.col("__at") - 1) / chunk).cast("bigint")
    return placed.withColumn("chunk_no", no).drop("__b", "__slot", "__at", "__before")


def call_report(calls: DataFrame, order_cols: Sequence[str], key_col: str = "key",
                error_col: str = "error_code", n: int = 5) -> DataFrame:
    """K4/A4/L1: per call, records, failures and the first ``n`` (order, code) pairs.

    A call holds at most one chunk of records, so the collected list is bounded.
    """
    code = F.struct(*[F.col(c) for c in order_cols], F.col(error_col).alias("error_code"))
    failed = F.array_sort(F.collect_list(F.when(F.col(error_col).isNotNull(), code)))
    return (calls.groupBy(key_col, "chunk_no")
            .agg(F.count(F.lit(1)).alias("n_records"), F.count(error_col).alias("n_failed"),
                 F.slice(failed, 1, n).alias("first_failures")))


def to_stream_records(df: DataFrame, key_col: str = "key",
                      timestamp_format: str | None = None) -> DataFrame:
    """K3/K4: ``key`` + JSON ``value`` — the shape of a keyed stream record."""
    payload = [c for c in df.columns if c != key_col]
    opts = {"timestampFormat": timestamp_format} if timestamp_format else {}
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*payload), opts).alias("value"))


def anomaly_records(anomalies: DataFrame) -> DataFrame:
    """K3: anomaly rows → stream records keyed by symbol.

    Timestamps are written as ``yyyy-MM-dd HH:mm:ss`` (session zone, UTC), the
    text the alerter keys on, so an alert key built from a streamed record
    equals the one built from the batch anomaly table (P15).
    """
    rec = anomalies.select(symbol_or_unknown(F.col("symbol")).alias("key"), "symbol",
                           "window_start", "window_end", "event_count", "detected_at")
    return to_stream_records(rec, timestamp_format=ALERT_TS_FORMAT)


def dual_write(batch: DataFrame, batch_id: int, writers: Sequence) -> None:
    """K7: write the same micro-batch to several sinks.

    The batch is persisted once so both writes read the same rows, and each
    writer gets the batch id so it can overwrite (not append twice) when a
    batch is replayed after a failure.
    """
    batch.persist()
    try:
        for w in writers:
            w(batch, batch_id)
    finally:
        batch.unpersist()


def batch_scoped_writer(path: str, fmt: str = "json", partition_cols: Sequence[str] = ()):
    """A ``foreachBatch`` writer that stores each batch under ``batch_id=<n>``.

    Replaying a batch overwrites only its own folder: idempotent per batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.write.mode("overwrite").format(fmt)
        if partition_cols:
            out = out.partitionBy(*partition_cols)
        out.save(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write
