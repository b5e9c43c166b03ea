"""The alerter (S9, P15–P20, D4 stream form, K8, A2).

Anomaly records arrive base64-encoded (a stream's ``data`` field).  Each is
decoded (undecodable → a bad row, skipped and not counted as processed),
keyed ``symbol|window_start``, and emitted as an alert only the first time
its key is seen within the expiry (30 days).

The job (``start_alerter``) keeps the keys in the query's own state
(``first_seen_in_state``: a value a key with an expiry, in RocksDB), reads no
stored alert, takes batches by record count and age (``sources.counted``) and
writes through a bisecting sink (``sinks.bisect``).  Batch tables and sinks
without such state have three other dedup forms:
- ``alerts_foreach_batch``: per micro-batch, a left-anti join against the
  alerts already stored and not yet expired (the stored table *is* the
  keyed state, like the conditional put it replaces); the key is stored
  with the alert in one write.  Exact wall-clock expiry, batch counters.
- ``dedup_event_time``: ``dropDuplicatesWithinWatermark`` on the key with
  a 30-day watermark on the window start (event-time expiry, state purged
  by the watermark).

- ``dedup_keyed_state``: a state per key with an expiry by the clock; nothing
  stored is read again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..fixed import ALERT_BATCH_RECORDS, ALERT_BATCH_SECONDS, ALERT_TRIES
from ..fixed import ALERT_TTL_DAYS as TTL_DAYS
from ..functions import keys, timecols
from ..session import path_exists, rocksdb_session
from ..sinks.bisect import bisecting_writer
from ..sources.counted import counted_stream

TWICE = StorageLevel.MEMORY_AND_DISK

# The columns of the stored alerts that are read back.
STORED_ALERT = StructType([
    StructField("dedup_key", StringType()), StructField("ttl", LongType()),
    StructField("batch_id", LongType()), StructField("seen_day", StringType())])

# The anomaly as the alerter decodes it: timestamps stay text.
ANOMALY_TEXT = StructType([
    StructField("symbol", StringType()), StructField("window_start", StringType()),
    StructField("window_end", StringType()), StructField("event_count", LongType()),
    StructField("detected_at", StringType()),
])


def decode(records: DataFrame, data_col: str = "data") -> DataFrame:
    """base64 → JSON object → fields, plus ``ok`` (decodable object)."""
    text = F.try_to_binary(F.col(data_col), F.lit("base64")).cast("string")
    full = StructType(list(ANOMALY_TEXT.fields) + [StructField("_corrupt_record", StringType())])
    parsed = F.from_json(text, full, {"mode": "PERMISSIVE",
                                      "columnNameOfCorruptRecord": "_corrupt_record"})
    out = records.select("*", parsed.alias("a"))
    ok = F.col("a").isNotNull() & F.col("a._corrupt_record").isNull() & F.ltrim(text).startswith("{")
    return out.select("*", *[F.col(f"a.{f.name}").alias(f.name) for f in ANOMALY_TEXT.fields],
                      F.coalesce(ok, F.lit(False)).alias("ok")).drop("a")


def alert_rows(decoded: DataFrame, now=None) -> DataFrame:
    """Key, subject, body, first_seen text and ttl for good rows."""
    clock = now if now is not None else F.current_timestamp()
    return decoded.where("ok").select(
        keys.alert_key("symbol", "window_start", window_start_is_text=True).alias("dedup_key"),
        "symbol", "window_start", "window_end", "event_count", "detected_at",
        keys.alert_subject("symbol", "event_count").alias("subject"),
        keys.alert_body("symbol", "window_start", "window_end", "event_count", "detected_at")
        .alias("body"),
        timecols.iso_utc(clock).alias("first_seen"),
        timecols.ttl_epoch(clock, TTL_DAYS).alias("ttl"))


def new_alerts(batch: DataFrame, seen: DataFrame | None, now_epoch: int | None = None) -> DataFrame:
    """D4 within one batch: one alert per key (first in the batch), minus keys
    already stored and unexpired."""
    rows = batch.withColumn("__i", F.monotonically_increasing_id())
    first = rows.groupBy("dedup_key").agg(F.min(F.struct("__i", *[c for c in batch.columns
                                                                   if c != "dedup_key"])).alias("r"))
    first = first.select("dedup_key", *[F.col(f"r.{c}").alias(c) for c in batch.columns
                                        if c != "dedup_key"])
    if seen is None:
        return first
    live = seen if now_epoch is None else seen.where(F.col("ttl") > F.lit(now_epoch))
    return first.join(live.select("dedup_key").distinct(), "dedup_key", "left_anti")


def _live_alerts(spark, alerts_path: str, now_epoch: int):
    """Stored alerts that can still suppress: only the first-seen days inside
    the expiry are read (partition pruning on ``seen_day``)."""
    if not path_exists(spark, alerts_path):  # first batch: no alerts stored yet
        return None
    stored = spark.read.schema(STORED_ALERT).parquet(alerts_path)
    oldest = F.date_format(F.timestamp_seconds(F.lit(now_epoch - TTL_DAYS * 86400 - 86400)),
                           "yyyy-MM-dd")
    return stored.where(F.col("seen_day") >= oldest)


def alerts_foreach_batch(alerts_path: str, summary_path: str | None = None, data_col: str = "data"):
    """K8 + A2 as a ``foreachBatch`` function over raw anomaly records.

    Alerts are stored partitioned by first-seen day, so each micro-batch reads
    only the last 30 days of keys, however long the alert history grows.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        decoded = decode(batch, data_col).persist(TWICE)
        try:
            now_epoch = int(spark.sql("SELECT unix_timestamp()").first()[0])
            now = F.timestamp_seconds(F.lit(now_epoch))
            seen = _live_alerts(spark, alerts_path, now_epoch)
            fresh = (new_alerts(alert_rows(decoded, now), seen, now_epoch)
                     .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                     .withColumn("seen_day", F.date_format(now, "yyyy-MM-dd"))).persist(TWICE)
            if not fresh.isEmpty():
                fresh.write.mode("append").partitionBy("seen_day").parquet(alerts_path)
            if summary_path:
                # counted from what is stored: a replay that finds its alerts
                # already there still reports them
                live = _live_alerts(spark, alerts_path, now_epoch)
                sent = 0 if live is None else live.where(F.col("batch_id") == batch_id).count()
                s = decoded.agg(F.count_if("ok").alias("records_processed"),
                                F.count(F.lit(1)).alias("batch_size")) \
                    .withColumn("alerts_sent", F.lit(sent).cast("bigint"))
                s.coalesce(1).write.mode("overwrite").json(
                    f"{summary_path.rstrip('/')}/batch_id={batch_id}")
            fresh.unpersist()
        finally:
            decoded.unpersist()
    return run


def dedup_event_time(alerts: DataFrame, ttl: str = f"{TTL_DAYS} days") -> DataFrame:
    """D4 stream form with event-time expiry (window start + 30 days).

    Text that is no time gives a null event time: such alerts are compared with
    each other only, never an error.
    """
    ts = F.try_to_timestamp(F.col("window_start"))
    return (alerts.withColumn("__ws", ts).withWatermark("__ws", ttl)
                  .dropDuplicatesWithinWatermark(["dedup_key"]).drop("__ws"))


def dedup_keyed_state(alerts: DataFrame, ttl_seconds: int = TTL_DAYS * 86400) -> DataFrame:
    """D4 stream form with keyed state: an alert passes when its key holds no live
    state; the state is the key's expiry by the processing clock, and a timer
    drops it then.  Nothing that was stored before is read again, and the state
    grows with the live keys only.  Of a micro-batch's alerts with one key the
    one with the smallest body text passes.
    """
    def first_seen(key, frames, state):
        now = state.getCurrentProcessingTimeMs()
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for pdf in frames:
            least = pdf.sort_values(list(pdf.columns)).head(1)
            best = least if best is None or tuple(least.astype(str).iloc[0]) < tuple(
                best.astype(str).iloc[0]) else best
        if best is not None and (not state.exists or state.get[0] <= now):
            state.update((now + ttl_seconds * 1000,))
            yield best
        if state.exists:
            state.setTimeoutDuration(max(1, state.get[0] - now))

    return alerts.groupBy("dedup_key").applyInPandasWithState(
        first_seen, alerts.schema, "expires_ms bigint", "append", "ProcessingTimeTimeout")


STATE_ROW = ("ok boolean, dedup_key string, n bigint, symbol string, window_start string, window_end string, "
             "event_count bigint, detected_at string, subject string, body string, first_seen string, "
             "ttl bigint, seen_day string, file string, at bigint")


def keyed_alerts(records: DataFrame, data_col: str = "data", place_cols=("file", "at")) -> DataFrame:
    """Records (base64 ``data`` and their place in the input) → a row a record for
    ``first_seen_in_state``: key, alert fields, place, and ``n`` = 1.

    The clock is the micro-batch's (the one in the offset log), so a replayed
    batch gives the same texts and days.  Undecodable records have no key; they
    are dealt over 64 keys of their own by their text.
    """
    now = F.current_timestamp()
    file, at = (F.col(c) for c in place_cols)
    decoded = decode(records, data_col)
    alert = keys.alert_key("symbol", "window_start", window_start_is_text=True)
    junk = F.pmod(F.xxhash64(data_col), F.lit(64)).cast("string")
    return decoded.select(
        "ok", F.when(F.col("ok"), alert).otherwise(junk).alias("dedup_key"), F.lit(1).cast("bigint").alias("n"),
        "symbol", "window_start", "window_end", "event_count", "detected_at",
        keys.alert_subject("symbol", "event_count").alias("subject"),
        keys.alert_body("symbol", "window_start", "window_end", "event_count", "detected_at").alias("body"),
        timecols.iso_utc(now).alias("first_seen"), timecols.ttl_epoch(now, TTL_DAYS).alias("ttl"),
        F.date_format(now, "yyyy-MM-dd").alias("seen_day"), file.cast("string").alias("file"),
        at.cast("bigint").alias("at"))


def _combined(batches):
    """Rows of one key in an Arrow batch → the first of them, with their number."""
    import pyarrow as pa

    for b in batches:
        ok, key, n = (b.column(c).to_pylist() for c in ("ok", "dedup_key", "n"))
        first, count = {}, {}
        place = list(zip(b.column("file").to_pylist(), b.column("at").to_pylist(), strict=True))
        for i, k in enumerate(zip(ok, key, strict=True)):
            count[k] = count.get(k, 0) + n[i]
            if k not in first or (place[i][0] or "", place[i][1] or 0) < (
                    place[first[k]][0] or "", place[first[k]][1] or 0):
                first[k] = i
        got = b.take(pa.array(list(first.values()), pa.int64()))
        at = got.schema.get_field_index("n")
        yield got.set_column(at, "n", pa.array([count[k] for k in first], pa.int64()))


def _first_seen_processor(ttl_seconds: int):
    """The state of a key: when it was first seen.  (Made here: shipped by value.)"""
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    class FirstSeen(StatefulProcessor):
        def init(self, handle):
            self.seen = handle.getValueState("first_seen_ms", "ms bigint", ttlDurationMs=ttl_seconds * 1000)

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            first, n = None, 0
            for r in rows:
                n += r["n"]
                if first is None or (r["file"] or "", r["at"] or 0) < (first["file"] or "", first["at"] or 0):
                    first = r
            is_new = bool(first["ok"]) and not self.seen.exists()
            if is_new:
                self.seen.update((timerValues.getCurrentProcessingTimeInMs(),))
            yield Row(**(first.asDict() | {"n": n, "is_new": is_new}))

        def close(self):
            pass

    return FirstSeen()


def first_seen_in_state(alerts: DataFrame, ttl_seconds: int = TTL_DAYS * 86400) -> DataFrame:
    """D4/W7 stream form of the job: a row a key and micro-batch, the earliest by
    place, with ``n`` (records of the key in the batch) and ``is_new`` (the key
    held no live state, and does now).

    The state is the time of the first sight and lives in the query's own store
    (RocksDB) until ``ttl_seconds`` later by the processing clock; then the key
    is new again.  A repeated key doesn't move its expiry.  Copies are combined
    before the shuffle, so a key with a third of a batch's records arrives as a
    row a task.
    """
    combined = alerts.mapInArrow(_combined, STATE_ROW)
    return combined.groupBy("ok", "dedup_key").transformWithState(
        _first_seen_processor(ttl_seconds), STATE_ROW + ", is_new boolean", "Append", "ProcessingTime")


def store_alerts(alerts_path: str):
    """K8: alerts below ``seen_day=/batch_id=/part=``; writing a part again replaces it."""
    def write(rows: DataFrame, batch_id: int, part: str) -> None:
        (rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn("part", F.lit(part))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("seen_day", "batch_id", "part").parquet(alerts_path))
    return write


def alerts_from_state(alerts_path: str, summary_path: str | None = None, send=None, tries: int = 5):
    """K8 + A2 as a ``foreachBatch`` function over ``first_seen_in_state``.

    New alerts go through ``send(rows, batch_id, part)`` (by default they are
    stored at ``alerts_path``), isolated by halving (W8): an alert that can't be
    sent in ``tries`` tries ends in ``<alerts_path>_errors``.  The summary counts
    records, so a hot key's copies are in it.
    """
    base = alerts_path.rstrip("/")
    writer = bisecting_writer(send or store_alerts(alerts_path), f"{base}_ledger", f"{base}_errors",
                              ["dedup_key", "file", "at"], tries)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(TWICE)  # the state operator runs once
        try:
            fresh = batch.where("is_new").drop("ok", "n", "is_new")
            if not fresh.isEmpty():
                writer(fresh, batch_id)
            if summary_path:
                (batch.agg(F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias("records_processed"),
                           F.coalesce(F.sum("n"), F.lit(0)).alias("batch_size"),
                           F.count_if("is_new").alias("alerts_sent"))
                 .coalesce(1).write.mode("overwrite").json(f"{summary_path.rstrip('/')}/batch_id={batch_id}"))
        finally:
            batch.unpersist()
    return run


def start_alerter(spark, source_path: str, alerts_path: str, checkpoint: str,
                  summary_path: str | None = None, trigger: dict | None = None,
                  max_files_per_trigger: int | None = None, max_records: int = ALERT_BATCH_RECORDS,
                  max_seconds: float = ALERT_BATCH_SECONDS, ttl_seconds: int = TTL_DAYS * 86400, send=None,
                  tries: int = ALERT_TRIES, starting_at: str = "earliest"):
    """Anomaly records (JSON lines with a base64 ``data`` field) → alerts.

    A batch leaves with ``max_records`` records, or when its oldest one has waited
    ``max_seconds``.  A run with ``availableNow``, or with ``max_files_per_trigger``,
    takes whole files instead.  Seen keys are the query's state (kept in its
    checkpoint), so nothing that was stored is read again and a restart goes on.
    """
    session = rocksdb_session(spark)
    # expired keys count as unseen without a batch of their own: none is made for them
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    if max_files_per_trigger or "availableNow" in (trigger or {}):
        r = session.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        # the file's place is the best order a file stream has: rows of one file keep no number
        lines = r.load(source_path).select("value", F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.file_block_start").alias("at"))
    else:
        lines = counted_stream(session, source_path, max_records, max_seconds, starting_at=starting_at)
    data = F.from_json("value", "data string").getField("data").alias("data")
    seen = first_seen_in_state(keyed_alerts(lines.select(data, "file", "at")), ttl_seconds)
    return (seen.writeStream.outputMode("append")
            .foreachBatch(alerts_from_state(alerts_path, summary_path, send, tries))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def main(argv=None) -> None:
    """``python -m tidepool.streaming.alerter --source S --alerts A --checkpoint C``."""
    import argparse

    from pyspark.sql import SparkSession

    ap = argparse.ArgumentParser(description="anomaly alerter")
    ap.add_argument("--source", required=True)
    ap.add_argument("--alerts", required=True)
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--summary")
    ap.add_argument("--available-now", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("anomaly_alerter").getOrCreate()
    trigger = {"availableNow": True} if a.available_now else None
    start_alerter(spark, a.source, a.alerts, a.checkpoint, a.summary, trigger).awaitTermination()


if __name__ == "__main__":
    main()
