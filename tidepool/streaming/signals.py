"""Signals on a live tick stream — extension (X2, X8 stream forms).

The batch functions in ``operators.signals`` are reused unchanged: OHLC bars
are a windowed aggregation (append mode: a bar is emitted once, when the
watermark passes its end, and its state is dropped), and the latest quote
per symbol is a grouped aggregation in update mode (one state row per
symbol).

The rolling signals (X3-X7) follow the bars in the same query: a state per symbol
holds the figures of its last bars, and each bar that closes leaves with its
signals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import WATERMARK_DELAY
from ..operators.cdc import merge_partitions
from ..operators.signals import VOL_LIMITS, latest_quote, ohlc_bars
from ..session import rocksdb_session


def start_bars(ticks: DataFrame, sink_path: str, checkpoint: str, width: str = "1 minute",
               watermark: str = WATERMARK_DELAY, ts_col: str = "ts", tiebreak: str | None = None,
               trigger: dict | None = None, fmt: str = "parquet"):
    """X2 on a stream: bars appended to ``sink_path`` as their windows close."""
    bars = ohlc_bars(ticks.withWatermark(ts_col, watermark), width, ts_col=ts_col, tiebreak=tiebreak)
    return (bars.writeStream.outputMode("append").format(fmt)
            .option("path", sink_path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


SIGNAL_COLUMNS = ("avg_prev_volume double, is_spike boolean, gap double, is_gap boolean, momentum double, "
                  "log_return double, volatility double, regime string, zscore double")


def _signals_processor(spike_n, spike_k, gap_limit, momentum_n, vol_n, limits, zscore_n, keep):
    """List state: (close, volume, n_trades, log return) of the last bars.  (Made here: shipped by value.)"""
    import math
    from statistics import stdev

    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    def ratio(a, b):
        return a / b if a is not None and b not in (None, 0) else None

    def mean(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) / len(xs) if xs else None

    def spread(xs):
        xs = [x for x in xs if x is not None]
        return stdev(xs) if len(xs) > 1 else None

    class Signals(StatefulProcessor):
        def init(self, handle):
            self.last = handle.getListState("last_bars", "close double, volume bigint, n_trades bigint, log_return double")

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            held = [tuple(r) for r in self.last.get()] if self.last.exists() else []
            for bar in sorted(rows, key=lambda r: r["window_start"]):
                close, volume, n = bar["close"], bar["volume"], bar["n_trades"]
                before = held[-1][0] if held else None
                avg = mean([h[1] for h in held[-spike_n:]])
                move = ratio(bar["open"], before)
                back = ratio(close, held[-momentum_n][0]) if len(held) >= momentum_n else None
                grown = ratio(close, before)
                ret = math.log(grown) if grown is not None and grown > 0 else None
                vol = spread([*[h[3] for h in held[-(vol_n - 1):]], ret] if vol_n > 1 else [ret])
                trades = [h[2] for h in held[-zscore_n:]]
                sd = spread(trades)
                gap = None if move is None else move - 1
                yield Row(**bar.asDict(), avg_prev_volume=avg,
                          is_spike=avg is not None and volume is not None and volume > spike_k * avg,
                          gap=gap, is_gap=gap is not None and abs(gap) > gap_limit,
                          momentum=None if back is None else back - 1, log_return=ret, volatility=vol,
                          regime="unknown" if vol is None else "low" if vol < limits[0] else
                          "normal" if vol < limits[1] else "high",
                          zscore=(n - mean(trades)) / sd if sd else None)
                held = [*held, (close, volume, n, ret)][-keep:]
            self.last.put(held)

        def close(self):
            pass

    return Signals()


def live_signals(bars: DataFrame, spike_n: int = 5, spike_k: float = 2.0, gap_limit: float = 0.5,
                 momentum_n: int = 3, vol_n: int = 6, limits=VOL_LIMITS, zscore_n: int = 10) -> DataFrame:
    """X3-X7 on a stream of closed bars: each bar with the signals that the batch
    functions give it (spikes of volume, gap, momentum, volatility regime, z-score
    of the number of trades).

    A symbol's bars close in the order of time, whatever batch they come in; the
    state is the figures of its last ``max(...)`` bars, so it doesn't grow.
    """
    keep = max(spike_n, momentum_n, vol_n, zscore_n)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in bars.schema.fields)
    processor = _signals_processor(spike_n, spike_k, gap_limit, momentum_n, vol_n, tuple(limits), zscore_n, keep)
    return bars.groupBy("symbol").transformWithState(processor, f"{kind}, {SIGNAL_COLUMNS}", "Append", "None")


def start_live_signals(spark, read_ticks, sink_path: str, checkpoint: str, width: str = "1 minute",
                       watermark: str = WATERMARK_DELAY, ts_col: str = "ts", tiebreak: str | None = None,
                       trigger: dict | None = None, **signals):
    """X2-X7 on a tick stream: bars with their signals appended to ``sink_path`` as
    their windows close.  ``read_ticks(session)`` gives the stream; its session
    keeps the state in RocksDB."""
    ticks = read_ticks(rocksdb_session(spark))
    bars = ohlc_bars(ticks.withWatermark(ts_col, watermark), width, ts_col=ts_col, tiebreak=tiebreak)
    return (live_signals(bars, **signals).writeStream.outputMode("append").format("parquet")
            .option("path", sink_path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def start_latest_quotes(ticks: DataFrame, checkpoint: str, sink=None, path: str | None = None,
                        ts_col: str = "ts", tiebreak: str | None = None, trigger: dict | None = None):
    """X8 on a stream: the last tick per symbol, updated every micro-batch.

    ``sink`` is a ``foreachBatch`` function receiving the changed symbols (e.g.
    a merge into a quotes table); by default they are merged into a Parquet
    table of one row per symbol at ``path``.
    """
    q = latest_quote(ticks, ts_col=ts_col, tiebreak=tiebreak)
    order = [ts_col, *([tiebreak] if tiebreak else [])]

    def merge(batch: DataFrame, batch_id: int) -> None:
        # one folder per symbol prefix, so an update rewrites a part of the table
        rows = batch.withColumn("part", F.substring("symbol", 1, 1))
        merge_partitions(batch.sparkSession, path, rows, ["symbol"], order, ["part"])

    if sink is None and path is None:
        raise ValueError("give a sink function or a path")
    return (q.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(sink or merge).trigger(**(trigger or {"processingTime": "5 seconds"})).start())
