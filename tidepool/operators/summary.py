"""Run summaries, counters and error examples (A2–A5, L1).

Counters are aggregates over the data (one pass, partial aggregation) or
``observe`` metrics collected as a side effect of a write, never a loop
over collected rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def batch_summary(df: DataFrame, batch_cols, processed_col: str, alerted_col: str) -> DataFrame:
    """A2: per batch, records processed, alerts sent and batch size.

    ``processed_col``/``alerted_col`` are boolean columns; undecodable records
    count in the batch size but not as processed.
    """
    cols = [batch_cols] if isinstance(batch_cols, str) else list(batch_cols)
    return df.groupBy(*cols).agg(
        F.count_if(F.col(processed_col)).alias("records_processed"),
        F.count_if(F.col(alerted_col)).alias("alerts_sent"),
        F.count(F.lit(1)).alias("batch_size"))


def observe_batch(df: DataFrame, processed_col: str, alerted_col: str,
                  name: str = "batch_summary") -> tuple[DataFrame, Observation]:
    """A2 as metrics: attach counters that fill when ``df`` is written."""
    obs = Observation(name)
    out = df.observe(obs,
                     F.count_if(F.col(processed_col)).alias("records_processed"),
                     F.count_if(F.col(alerted_col)).alias("alerts_sent"),
                     F.count(F.lit(1)).alias("batch_size"))
    return out, obs


def per_symbol_summary(df: DataFrame, symbol_col: str, ok_col: str) -> DataFrame:
    """A3: per symbol, records written, records published, records in error."""
    return df.groupBy(F.col(symbol_col).alias("symbol")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col(ok_col)).alias("published"),
        F.count_if(~F.col(ok_col)).alias("errors"))


def publish_outcome(df: DataFrame, error_col: str = "error_code") -> DataFrame:
    """A4: attempted / published / failed counts in one row; a record failed when
    the response gave an error code for it."""
    failed = F.col(error_col).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("attempted"), F.count_if(~failed).alias("published"),
                  F.count_if(failed).alias("failed"))


def first_failures(df: DataFrame, order_cols, error_col: str = "error_code", n: int = 5) -> DataFrame:
    """L1 (with A4): the first ``n`` failed records, with their codes, in a fixed order.

    ``orderBy(...).limit(n)`` plans as a TakeOrderedAndProject: each task
    keeps its own top n and only those n×tasks rows meet on the driver.
    """
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    return df.where(F.col(error_col).isNotNull()).orderBy(*cols).limit(n)


def batches_with_alerts(records: DataFrame, alerts: DataFrame, batch_col: str,
                        processed_col: str) -> DataFrame:
    """A2 from two small tables: records counted per batch, alerts counted per
    batch, joined by batch; no record meets its alert."""
    per_batch = records.groupBy(batch_col).agg(
        F.count_if(F.col(processed_col)).alias("records_processed"),
        F.count(F.lit(1)).alias("batch_size"))
    sent = alerts.groupBy(batch_col).agg(F.count(F.lit(1)).alias("alerts_sent"))
    return (per_batch.join(sent, batch_col, "left")
            .select(batch_col, "records_processed",
                    F.coalesce("alerts_sent", F.lit(0).cast("bigint")).alias("alerts_sent"), "batch_size"))


def row_count(df: DataFrame) -> DataFrame:
    """A5: ``SELECT count(*)`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
