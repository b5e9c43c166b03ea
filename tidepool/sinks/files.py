"""File and table sinks.

Writes cluster rows by the output partition columns first, so each output
folder is written by few tasks instead of one small file per (task,
folder).  By default this is a ``REBALANCE`` hint: AQE then splits a folder
that holds a third of the data over several tasks and merges small ones,
from the real shuffle sizes.  ``files_per_partition`` instead fixes the
spread: rows go to N hash buckets per folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import padded_path_parts

DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000


def spread_by_partition(df: DataFrame, partition_cols: Sequence[str], files_per_partition: int = 1,
                        spread_col: str | None = None) -> DataFrame:
    """Cluster rows by output folder; split each folder over N writer tasks.

    The spread is a hash of ``spread_col`` (or of the whole row), never a
    random number: a retried task must send each row to the same partition.
    """
    cols = [F.col(c) for c in partition_cols]
    if files_per_partition > 1:
        spread = F.xxhash64(F.col(spread_col)) if spread_col else F.xxhash64(*df.columns)
        bucket = F.pmod(spread, F.lit(files_per_partition))
        return df.repartition(*cols, bucket)
    return df.hint("rebalance", *partition_cols)


def write_partitioned_ndjson(df: DataFrame, path: str, partition_cols: Sequence[str],
                             ts_col: str | None = None, hour: bool = True,
                             files_per_partition: int = 1, compression: str | None = None) -> None:
    """NDJSON under ``.../year=YYYY/month=MM/day=DD[/hour=HH]``.

    With ``ts_col`` the zero-padded year/month/day/hour text columns are
    derived from it (P21).  Dynamic partition overwrite replaces only the
    folders this write touches, so a rerun of the same fetch rewrites the
    same keys and leaves every other folder alone (idempotent).
    """
    out = df
    cols = list(partition_cols)
    if ts_col is not None:
        out = out.select("*", *padded_path_parts(ts_col, hour=hour))
        cols += ["year", "month", "day"] + (["hour"] if hour else [])
    w = (spread_by_partition(out, cols, files_per_partition).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*cols))
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_bronze(df: DataFrame, path: str, partition_cols: Sequence[str],
                 table: str | None = None, mode: str = "append", files_per_partition: int = 1,
                 spread_col: str | None = None,
                 max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE) -> None:
    """K2: Parquet/Snappy partitioned table; registers or updates the table
    in the catalog when ``table`` is given."""
    w = (spread_by_partition(df, partition_cols, files_per_partition, spread_col)
         .write.mode(mode).format("parquet").option("compression", "snappy")
         .option("maxRecordsPerFile", max_records_per_file).partitionBy(*partition_cols))
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)


def write_errors(bad: DataFrame, path: str, error_type: str, date_col: str | None = None,
                 day: str | None = None, files_per_partition: int = 4,
                 batch_id: int | None = None) -> None:
    """K6: malformed rows under ``error_type=<type>/date=<yyyy-MM-dd>``.

    The date is taken from ``date_col``, else ``day``, else the processing day.
    With ``batch_id`` (a micro-batch) the rows go below a folder of that batch,
    which a replay replaces, so a batch never counts twice.
    """
    if date_col:
        date = F.date_format(F.col(date_col), "yyyy-MM-dd")
    else:
        date = F.lit(day) if day else F.date_format(F.current_date(), "yyyy-MM-dd")
    out = bad.withColumn("error_type", F.lit(error_type)).withColumn("date", date)
    if batch_id is not None:
        path = f"{path.rstrip('/')}/batch_id={batch_id}"
    (spread_by_partition(out, ["error_type", "date"], files_per_partition)
        .write.mode("append" if batch_id is None else "overwrite")
        .partitionBy("error_type", "date").json(path))


def write_if_nonempty(df: DataFrame, writer) -> bool:
    """K9: skip the write (and any folder/catalog change) when ``df`` is empty.

    ``isEmpty`` stops at the first row found, so on a non-empty input it
    costs a fraction of one task.
    """
    if df.isEmpty():
        return False
    writer(df)
    return True


def create_table_as(spark, name: str, location: str, select_sql: str, fmt: str = "parquet",
                    partition_cols: Sequence[str] = ()) -> DataFrame:
    """``CREATE TABLE … USING parquet LOCATION … AS SELECT`` (silver/gold)."""
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE {name} USING {fmt}{parts} LOCATION '{location}' AS {select_sql}")
    return spark.table(name)
