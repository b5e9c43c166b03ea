"""Poison isolation in a micro-batch sink (W8): halve, retry, set aside.

A batch whose write fails is not retried whole for ever.  Its rows are numbered
in order and kept below the ledger folder; the range is halved, the earlier half
written first, and so on down to single rows.  A single row is tried ``tries``
times, then goes to the error output (K6) with its last error; all others land
once, and in order, since ranges are written one after another.

The ledger (a JSON line per event) and the numbered rows make it survive a lost
driver: the replayed batch goes on where it stopped, with the tries it had.  A
batch that writes well costs nothing: no ledger, no numbering.

A range's bounds stay on the driver, never its rows: halving is a filter on the
stored rows and an approximate median.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import path_exists
from .files import write_errors

LEDGER = "lo bigint, hi bigint, event string, tries int, mid bigint, error string"


def _note(spark, home: str, lo: int, hi: int, event: str, tries: int = 0, mid: int | None = None,
          error: str | None = None) -> None:
    spark.createDataFrame([(lo, hi, event, tries, mid, error)], LEDGER).coalesce(1).write.mode("append").json(
        f"{home}/events")


def _brief(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"[:2000]


def bisecting_writer(write: Callable[[DataFrame, int, str], None], ledger_path: str, errors_path: str,
                     order_cols: Sequence[str], tries: int = 5, pause_seconds: float = 0.0):
    """A ``foreachBatch`` function around ``write(rows, batch_id, part)``.

    ``write`` raises when any row can't be written, and must then have left
    nothing behind (a file write does), or be idempotent per row.  ``part`` names
    the rows within the batch ("all", or a range of their numbers): the same part
    is always the same rows, so a sink that replaces a part is written once however
    often a batch is replayed.  ``order_cols`` give the order to keep; rows equal
    in them may come in any order.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        home = f"{ledger_path.rstrip('/')}/batch_id={batch_id}"
        if not path_exists(spark, f"{home}/rows/_SUCCESS"):
            try:
                write(batch, batch_id, "all")
                return
            except Exception:  # whatever the sink raises: find the rows it can't take
                (batch.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
                 .withColumn("__no", F.monotonically_increasing_id())
                 .write.mode("overwrite").parquet(f"{home}/rows"))
        rows = spark.read.parquet(f"{home}/rows")
        settled, split, tried = {}, {}, {}
        if path_exists(spark, f"{home}/events"):
            for e in spark.read.schema(LEDGER).json(f"{home}/events").collect():
                if e.event in ("landed", "dead"):
                    settled[e.lo, e.hi] = e.event, e.tries, e.error
                elif e.event == "split":
                    split[e.lo, e.hi] = e.mid
                elif e.event == "failed":
                    tried[e.lo, e.hi] = max(e.tries, tried.get((e.lo, e.hi), 0))
        lo, hi = rows.agg(F.min("__no"), F.max("__no")).first()
        todo = [(lo, hi)] if lo is not None else []
        while todo:
            lo, hi = todo.pop()
            if (lo, hi) in settled:
                continue
            own = rows.where(F.col("__no").between(lo, hi))
            if (lo, hi) not in split:
                try:
                    write(own.drop("__no"), batch_id, f"{lo}-{hi}")
                    _note(spark, home, lo, hi, "landed")
                    continue
                except Exception as e:
                    error = _brief(e)
                if lo == hi:
                    n = tried[lo, hi] = tried.get((lo, hi), 0) + 1
                    if n >= tries:
                        settled[lo, hi] = "dead", n, error
                        _note(spark, home, lo, hi, "dead", n, error=error)
                    else:
                        _note(spark, home, lo, hi, "failed", n, error=error)
                        time.sleep(pause_seconds)
                        todo.append((lo, hi))
                    continue
                split[lo, hi] = own.agg(F.percentile_approx("__no", 0.5, 100_000)).first()[0]
                _note(spark, home, lo, hi, "split", mid=split[lo, hi])
            mid = min(split[lo, hi], hi - 1)
            left, right = rows.agg(F.max(F.when(F.col("__no").between(lo, mid), F.col("__no"))),
                                   F.min(F.when(F.col("__no").between(mid + 1, hi), F.col("__no")))).first()
            todo += [(right, hi), (lo, left)]  # the earlier half is on top
        dead = [(lo, n, error) for (lo, _), (event, n, error) in settled.items() if event == "dead"]
        if dead:
            why = spark.createDataFrame(dead, "__no bigint, tries int, error string")
            write_errors(rows.join(F.broadcast(why), "__no").drop("__no"), errors_path, "write_failed",
                         batch_id=batch_id)
    return run
