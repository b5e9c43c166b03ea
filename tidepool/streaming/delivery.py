"""X15 on streams: the directly fetched and the streamed records, compared as they arrive.

A stream-stream full outer join with a time bound.  Each side keeps the first
delivery of a key; a pair leaves when its second record arrives, a record alone
once the watermark says that its partner can't come any more.  State is bounded
by the delay, not by the streams' length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELAY = "1 hour"
LATENESS = "10 minutes"


def compare_streams(direct: DataFrame, streamed: DataFrame, key: str, direct_ts: str, streamed_ts: str,
                    delay: str = DELAY, lateness: str = LATENESS) -> DataFrame:
    """X15 (stream form): ``key, status, latency_seconds``, each record once.

    ``status`` is both / only_direct / only_streamed.  Two records of a key are
    one delivery when they lie at most ``delay`` apart, in either direction;
    ``lateness`` is how far a side may be out of order.  Of a key's repeated
    deliveries on a side, within ``lateness`` of each other, the first to arrive
    counts.  Records with a null key are alone, one a side within ``lateness``.
    Times are timestamps; a record without one takes no part.
    """
    def side(df, ts, name):
        return (df.where(F.col(ts).isNotNull()).select(F.col(key).alias(f"__k_{name}"), F.col(ts).alias(f"__{name}"))
                .withWatermark(f"__{name}", lateness).dropDuplicatesWithinWatermark([f"__k_{name}"]))

    d, s = side(direct, direct_ts, "d"), side(streamed, streamed_ts, "s")
    bound = F.expr(f"INTERVAL {delay}")
    near = (F.col("__s") >= F.col("__d") - bound) & (F.col("__s") <= F.col("__d") + bound)
    j = d.join(s, (F.col("__k_d") == F.col("__k_s")) & near, "full_outer")
    status = (F.when(F.col("__s").isNull(), F.lit("only_direct"))
               .when(F.col("__d").isNull(), F.lit("only_streamed")).otherwise(F.lit("both")))
    return j.select(F.coalesce("__k_d", "__k_s").alias(key), status.alias("status"),
                    (F.unix_timestamp("__s") - F.unix_timestamp("__d")).alias("latency_seconds"))


def start_delivery_check(direct: DataFrame, streamed: DataFrame, key: str, direct_ts: str, streamed_ts: str,
                         sink_path: str, checkpoint: str, delay: str = DELAY, lateness: str = LATENESS,
                         trigger: dict | None = None):
    """X15 on streams: compared records appended to ``sink_path`` (Parquet)."""
    out = compare_streams(direct, streamed, key, direct_ts, streamed_ts, delay, lateness)
    return (out.writeStream.outputMode("append").format("parquet").option("path", sink_path)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())
