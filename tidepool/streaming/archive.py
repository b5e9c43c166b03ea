"""Stream archive and dual writes.

The archive lands every stream record under its *arrival* hour
(``year=/month=/day=/hour=``), gzip JSON by default or Parquet (X16).  The
trigger interval plays the role of the delivery buffer (60 s); the file
sink commits each micro-batch atomically through its log, so a replayed
batch does not duplicate files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.publish import dual_write


def with_arrival_partitions(stream: DataFrame, arrival_col: str | None = None) -> DataFrame:
    """Add zero-padded arrival-time ``year/month/day/hour`` columns.

    ``arrival_col`` (e.g. a source's record timestamp) is used when given,
    else the micro-batch clock.
    """
    t = F.col(arrival_col) if arrival_col else F.current_timestamp()
    return stream.select("*", F.date_format(t, "yyyy").alias("year"),
                         F.date_format(t, "MM").alias("month"), F.date_format(t, "dd").alias("day"),
                         F.date_format(t, "HH").alias("hour"))


def start_archive(stream: DataFrame, path: str, checkpoint: str, fmt: str = "json",
                  arrival_col: str | None = None, trigger: dict | None = None,
                  max_records_per_file: int | None = None):
    """K5 (``fmt='json'``, gzip) / X16 (``fmt='parquet'``)."""
    out = with_arrival_partitions(stream, arrival_col)
    w = (out.writeStream.format(fmt).outputMode("append").partitionBy("year", "month", "day", "hour")
         .option("checkpointLocation", checkpoint).option("path", path))
    if fmt == "json":
        w = w.option("compression", "gzip")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def start_dual_write(stream: DataFrame, checkpoint: str, writers: Sequence,
                     trigger: dict | None = None):
    """K7: the same micro-batch to several sinks, each idempotent per batch id."""
    return (stream.writeStream.foreachBatch(lambda b, i: dual_write(b, i, writers))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def convert_archive(spark, archive_path: str, out_path: str, concatenated: bool = True,
                    files_per_partition: int = 1, **reader) -> None:
    """X16 (batch form): the gzip JSON archive rewritten as Parquet under the
    same arrival-hour folders; malformed records are kept aside in
    ``_corrupt_record`` (null for good rows)."""
    from ..sinks.files import spread_by_partition
    from ..sources.archive import read_archive

    recs = read_archive(spark, archive_path, concatenated=concatenated, **reader)
    parts = ["year", "month", "day", "hour"]
    (spread_by_partition(recs, parts, files_per_partition).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(out_path))
