"""Raw news → bronze and raw bars → bronze, as batch jobs; news also as an
incremental stream.

Batch: scan (fixed schema, partition discovery, optional ``modifiedAfter``)
→ malformed rows to the error output → skip when empty → transform (one
shuffle, the dedup) → partitioned Parquet append.

Incremental (the bookmark replaced by a checkpoint): a file stream over the
raw folder with ``trigger(availableNow=True)``; each micro-batch runs the
same batch transform in ``foreachBatch``.  A restarted run resumes from
the last committed batch, so no file is processed twice and none is lost.

Malformed rows are never dropped unseen: without ``errors_path`` they go next
to the bronze table, to ``<bronze_path>_errors``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.bronze import bronze_bars, bronze_news
from ..operators.filters import split_malformed
from ..session import path_exists
from ..sinks.files import write_bronze, write_errors, write_if_nonempty
from ..sources.raw import read_raw_bars, read_raw_news, stream_json_table

# Raw rows are read twice (good rows, malformed rows); what doesn't fit in memory goes to disk.
TWICE = StorageLevel.MEMORY_AND_DISK


def errors_beside(bronze_path: str, errors_path: str | None) -> str:
    return errors_path or f"{bronze_path.rstrip('/')}_errors"


def transform_batch(raw: DataFrame, errors_path: str, ingestion_ts=None,
                    batch_id: int | None = None) -> DataFrame:
    """Write the malformed rows (K6) and return the bronze rows of the rest."""
    good, bad = split_malformed(raw)
    if S.CORRUPT_COL in raw.columns:
        write_if_nonempty(bad.select(S.CORRUPT_COL), lambda b: write_errors(
            b, errors_path, "malformed_json", batch_id=batch_id))
    return bronze_news(good, ingestion_ts=ingestion_ts)


def run_batch(spark: SparkSession, raw_path: str, bronze_path: str, table: str | None = None,
              errors_path: str | None = None, modified_after: str | None = None,
              ingestion_ts=None, files_per_partition: int = 1) -> bool:
    """Run one news batch; returns False when there was nothing new to write.

    Emptiness is tested on the raw input (stops at the first row found), not
    on the deduplicated output, so the dedup runs once, inside the write.
    """
    raw = read_raw_news(spark, raw_path, modified_after=modified_after)
    if raw.isEmpty():
        return False
    raw = raw.persist(TWICE)
    try:
        out = transform_batch(raw, errors_beside(bronze_path, errors_path), ingestion_ts)
        write_bronze(out, bronze_path, S.BRONZE_NEWS_PARTITIONS, table=table,
                     files_per_partition=files_per_partition, spread_col="dedup_key")
        return True
    finally:
        raw.unpersist()


def run_bars_batch(spark: SparkSession, raw_path: str, bronze_path: str, table: str | None = None,
                   modified_after: str | None = None, ingestion_ts=None) -> bool:
    """Raw daily bars → bronze bars; a malformed line fails the read, as configured
    for this source.  Returns False when there was nothing new."""
    raw = read_raw_bars(spark, raw_path, modified_after=modified_after)
    if raw.isEmpty():
        return False
    write_bronze(bronze_bars(raw, ingestion_ts), bronze_path, S.BRONZE_BARS_PARTITIONS, table=table)
    return True


# What tells two bronze articles apart (null parts are equal to each other).
BRONZE_IDENTITY = ("dedup_key", "published_at", "url")


def skip_written(spark: SparkSession, out: DataFrame, bronze_path: str,
                 table: str | None = None) -> DataFrame:
    """Drop rows that are already in bronze.

    A micro-batch replayed after a failure between its write and its commit
    then writes nothing twice.  Only the identity columns are read, and only of
    the partitions the batch touches: an equality semi-join on the partition
    columns, which Spark turns into partition pruning at runtime; rows without
    a date or symbol are compared with the null partitions.
    """
    parts = S.BRONZE_NEWS_PARTITIONS
    if table and spark.catalog.tableExists(table):
        existing = spark.table(table)
    elif path_exists(spark, bronze_path):
        existing = spark.read.schema(S.BRONZE_NEWS).parquet(bronze_path)
    else:
        return out
    names = [*parts, *BRONZE_IDENTITY]
    existing = existing.select(*names)
    dated = F.lit(True)
    for c in parts:
        dated = dated & F.col(c).isNotNull()
    touched = out.where(dated).select(*parts).distinct()
    seen = existing.join(touched, parts, "left_semi").unionByName(existing.where(~dated))
    seen = seen.select(*[F.col(c).alias(f"__s_{c}") for c in names])
    return out.join(seen, [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in names], "left_anti")


def start_incremental(spark: SparkSession, raw_path: str, bronze_path: str, checkpoint: str,
                      errors_path: str | None = None, max_files_per_trigger: int | None = None,
                      available_now: bool = True, processing_time: str | None = None,
                      table: str | None = None):
    """Start the checkpointed incremental job; returns the ``StreamingQuery``.

    Give ``table`` (a catalog table over ``bronze_path``) at scale: appends
    then register their partitions in the catalog, and the replay check
    prunes partitions there instead of listing every bronze folder.
    """
    stream = stream_json_table(spark, raw_path, S.RAW_NEWS_DATA, S.RAW_NEWS_PARTITIONS,
                               max_files_per_trigger)

    errors = errors_beside(bronze_path, errors_path)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # K9: nothing new, no write
            return
        batch = batch.persist(TWICE)
        try:
            rows = transform_batch(batch, errors, batch_id=batch_id).persist(TWICE)  # check, write
            try:
                out = skip_written(spark, rows, bronze_path, table)
                write_bronze(out, bronze_path, S.BRONZE_NEWS_PARTITIONS, table=table)
            finally:
                rows.unpersist()
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def main(argv=None) -> None:
    """``python -m tidepool.plans.bronze_job --raw R --bronze B [--checkpoint C]``."""
    import argparse

    ap = argparse.ArgumentParser(description="raw news (or bars) → bronze")
    ap.add_argument("--bars", action="store_true", help="the raw folder holds daily bars")
    ap.add_argument("--raw", required=True)
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--errors")
    ap.add_argument("--table")
    ap.add_argument("--checkpoint", help="incremental mode: checkpoint folder of the file stream")
    ap.add_argument("--modified-after", help="batch mode: only files changed after this time")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("raw_to_bronze_news").getOrCreate()
    if a.bars:
        run_bars_batch(spark, a.raw, a.bronze, table=a.table, modified_after=a.modified_after)
    elif a.checkpoint:
        start_incremental(spark, a.raw, a.bronze, a.checkpoint, a.errors,
                          table=a.table).awaitTermination()
    else:
        run_batch(spark, a.raw, a.bronze, table=a.table, errors_path=a.errors,
                  modified_after=a.modified_after)


if __name__ == "__main__":
    main()
