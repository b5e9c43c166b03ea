"""The streaming anomaly detector.

``readStream`` → ``from_json`` (bad records split off, never failing the
batch) → event time from epoch seconds → 30 s watermark → 5-minute tumbling
count per symbol → ``count >= threshold`` → append sink.

In append mode a window is emitted once, after the watermark passes its
end, and its state is dropped then: state is bounded by the watermark, not
by the stream's length.  The aggregation is keyed by (window, symbol) and
has a partial step per micro-batch task, so a hot symbol does not pile its
raw rows onto one task.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas as S
from ..functions.timecols import epoch_seconds_to_timestamp_millis
from ..operators.windows import DEFAULT_THRESHOLD, DEFAULT_WINDOW, detect_anomalies
from ..fixed import WATERMARK_DELAY
from ..session import rocksdb_session
from ..sinks.publish import anomaly_records


def parse_records(stream: DataFrame, schema: StructType = S.DETECTOR_SOURCE,
                  value_col: str = "value", keep=()) -> tuple[DataFrame, DataFrame]:
    """JSON text → typed rows; (good, bad) with bad keeping the text.

    ``keep`` names columns carried through unchanged (e.g. a record id).
    Truncated text, wrong types, arrays and plain text all land in ``bad``.
    """
    full = StructType(list(schema.fields) + [StructField(S.CORRUPT_COL, StringType())])
    parsed = stream.select(*keep, F.from_json(F.col(value_col), full, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COL}).alias("r"),
        F.col(value_col).alias("__raw"))
    is_obj = F.ltrim(F.col("__raw")).startswith("{")
    ok = F.col(f"r.{S.CORRUPT_COL}").isNull() & F.col("r").isNotNull() & is_obj
    good = parsed.where(ok).select(*keep, *[F.col(f"r.{f.name}").alias(f.name)
                                            for f in schema.fields])
    bad = parsed.where(~F.coalesce(ok, F.lit(False))).select(
        *keep, F.col("__raw").alias(S.CORRUPT_COL))
    return good, bad


def with_event_time(events: DataFrame, watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """P4 + W1: ``published_at`` from ``datetime`` seconds, with the watermark.

    Rows with a null ``datetime`` get a null event time and fall in no window
    (the count of such rows is observable, see ``observe_input``).
    """
    out = events.withColumn("published_at", epoch_seconds_to_timestamp_millis("datetime"))
    return out.withWatermark("published_at", watermark) if watermark else out


def observe_input(events: DataFrame, name: str = "detector_input") -> DataFrame:
    """Count input rows and rows without event time per micro-batch."""
    return events.observe(name, F.count(F.lit(1)).alias("rows"),
                          F.count_if(F.col("published_at").isNull()).alias("null_event_time"))


def detector(events: DataFrame, threshold: int = DEFAULT_THRESHOLD, width: str = DEFAULT_WINDOW,
             watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """The detector as a DataFrame function (batch or streaming input)."""
    timed = observe_input(with_event_time(events, watermark))
    return detect_anomalies(timed, threshold=threshold, width=width)


def file_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                      start_after: str | None = None) -> DataFrame:
    """S8 on a folder of stream records (one JSON object per line, text kept).

    ``start_after`` (a timestamp text) skips files written before it: the
    file-source counterpart of "start at latest" (W6).
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(path)
    if start_after:
        df = df.where(F.col("_metadata.file_modification_time") > F.lit(start_after).cast("timestamp"))
    return df.select("value")


class QueryGroup:
    """Streaming queries that belong together: waited for, stopped and watched as one.

    Other attributes are those of the first query.
    """

    def __init__(self, *queries):
        self.queries = queries

    def awaitTermination(self, timeout: float | None = None):  # noqa: N802  (Spark's name)
        """Wait for all of them; raises if any failed.  With ``timeout`` (seconds
        for all together) returns whether all have ended."""
        if timeout is None:
            for q in self.queries:
                q.awaitTermination()
            return None
        end = time.monotonic() + timeout
        return all([q.awaitTermination(max(0, math.ceil(end - time.monotonic()))) for q in self.queries])

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    def __getattr__(self, name):
        return getattr(self.queries[0], name)


def start_detector(source: DataFrame, sink_path: str, checkpoint: str,
                   threshold: int = DEFAULT_THRESHOLD, width: str = DEFAULT_WINDOW,
                   watermark: str = WATERMARK_DELAY, errors_path: str | None = None,
                   trigger: dict | None = None, fmt: str = "json", query_name: str | None = None):
    """Run E2: records from ``source`` (a streaming frame with a ``value``
    text column) → anomaly records appended to ``sink_path`` (W4: one commit
    per micro-batch in ``checkpoint``).  ``trigger`` defaults to every 60 s.

    Malformed records go to ``errors_path`` (by default beside the sink) in a
    query of their own: an append sink can't take raw rows and windows at once.
    Both queries are returned as one, so waiting for it waits for the errors too.
    """
    trigger = trigger or {"processingTime": "60 seconds"}
    good, bad = parse_records(source)
    out = anomaly_records(detector(good, threshold, width, watermark))
    w = (out.writeStream.outputMode("append").format(fmt)
         .option("checkpointLocation", checkpoint).option("path", sink_path))
    if query_name:
        w = w.queryName(query_name)
    main_query = w.trigger(**trigger).start()
    errors = (bad.withColumn("error_type", F.lit("malformed_json"))
              .withColumn("date", F.date_format(F.current_timestamp(), "yyyy-MM-dd"))
              .writeStream.format("json").partitionBy("error_type", "date")
              .option("checkpointLocation", checkpoint.rstrip("/") + "_errors")
              .option("path", errors_path or sink_path.rstrip("/") + "_errors")
              .trigger(**trigger).start())
    return QueryGroup(main_query, errors)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a detector's last committed batch holds open, read from
    its checkpoint: ``symbol, window_start, window_end, event_count``.

    The state data source reads what the store wrote (with RocksDB, its snapshots
    and changes), so the job may be stopped or run elsewhere.
    """
    state = spark.read.format("statestore").load(checkpoint)
    names = {f.name: f.name for f in state.schema["key"].dataType.fields}
    window = next(n for n in names if "window" in n)
    symbol = next(n for n in names if n != window)
    count = state.schema["value"].dataType.fields[0].name
    return state.select(F.col(f"key.`{symbol}`").alias("symbol"), F.col(f"key.`{window}`.start").alias("window_start"),
                        F.col(f"key.`{window}`.end").alias("window_end"),
                        F.col(f"value.`{count}`").alias("event_count"))


class InputTotals(StreamingQueryListener):
    """Totals over a whole run: rows, rows without event time, late rows dropped.

    ``recentProgress`` keeps the last hundred micro-batches only; a listener
    sees every one.  Add it with ``spark.streams.addListener`` before starting
    the queries.  Totals are kept by query id.  Spark counts late rows at the
    state operator, i.e. after the map-side partial aggregate: late raw rows of
    one (window, symbol) in one task count once.
    """

    def __init__(self, metrics: str = "detector_input"):
        self.metrics = metrics
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        mine = self.totals.setdefault(str(p.id), {"rows": 0, "null_event_time": 0, "dropped_late": 0})
        seen = (p.observedMetrics or {}).get(self.metrics)
        for k in ("rows", "null_event_time"):
            mine[k] += int(seen[k] or 0) if seen is not None else 0
        mine["dropped_late"] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def of(self, query) -> dict[str, int]:
        return dict(self.totals.get(str(query.id), {"rows": 0, "null_event_time": 0, "dropped_late": 0}))


def kafka_event_stream(spark: SparkSession, servers: str, topic: str,
                       starting_offsets: str = "latest",
                       max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S8/W6 on a Kafka topic: ``value`` as text, starting at the latest offset.

    Needs the Spark Kafka connector on the classpath (not in this image; the
    tests use the file source).  ``max_offsets_per_trigger`` bounds a
    micro-batch (W5).
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("value").cast("string").alias("value"))


def to_kafka(records: DataFrame, servers: str, topic: str, checkpoint: str,
             trigger: dict | None = None):
    """K3 on a Kafka topic: ``key``/``value`` records, keyed by symbol."""
    return (records.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def main(argv=None) -> None:
    """``python -m tidepool.streaming.detector --source S --sink K --checkpoint C``."""
    import argparse

    ap = argparse.ArgumentParser(description="streaming anomaly detector")
    ap.add_argument("--source", required=True, help="folder of stream records (JSON lines)")
    ap.add_argument("--sink", required=True)
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--errors")
    ap.add_argument("--threshold", type=int, default=DEFAULT_THRESHOLD)
    ap.add_argument("--window", default=DEFAULT_WINDOW)
    ap.add_argument("--start-after", help="skip files written before this time (start at latest)")
    ap.add_argument("--available-now", action="store_true")
    a = ap.parse_args(argv)
    spark = rocksdb_session(SparkSession.builder.appName("anomaly_detector").getOrCreate())
    trigger = {"availableNow": True} if a.available_now else {"processingTime": "60 seconds"}
    q = start_detector(file_event_stream(spark, a.source, start_after=a.start_after), a.sink,
                       a.checkpoint, a.threshold, a.window, errors_path=a.errors, trigger=trigger)
    q.awaitTermination()


if __name__ == "__main__":
    main()
