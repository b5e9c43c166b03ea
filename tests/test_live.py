"""Joins and signals on live streams equal their batch forms; the detector's state read back."""

import datetime as dt
import glob
import os
import random
import time

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from tidepool.operators import gold, signals
from tidepool.operators.joins import interval_join
from tidepool.plans import driver_views as V
from tidepool.session import rocksdb_session
from tidepool.streaming import delivery, detector
from tidepool.streaming import signals as live

T0 = dt.datetime(2026, 3, 1)


def aged(folder, pattern="part-*"):
    """The file source reads oldest first: give the files their order."""
    t0 = time.time() - 1000
    for i, f in enumerate(sorted(glob.glob(f"{folder}/{pattern}"))):
        os.utime(f, (t0 + i, t0 + i))


def drop_files(spark, rows, schema, folder, batches):
    """The rows as files, one a micro-batch, in the order given."""
    size = -(-len(rows) // batches)
    for i in range(batches):
        part = rows[i * size:(i + 1) * size]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(f"{folder}/{i:03d}")
        for f in glob.glob(f"{folder}/{i:03d}/part-*"):
            os.replace(f, f"{folder}/part-{i:03d}.json")
    aged(folder, "part-*.json")


def test_streamed_and_direct_records_are_compared_once(spark, tmp_path):
    rng = random.Random(4)
    direct, streamed = [], []
    for i in range(400):
        at = T0 + dt.timedelta(seconds=30 * i)
        lag = dt.timedelta(seconds=rng.randint(-300, 1500))
        if i % 7 != 1:
            direct.append((i, at))
        if i % 5 != 2:
            streamed.append((i, at + lag))
        if i % 50 == 0:  # a record delivered again a little later
            direct.append((i, at + dt.timedelta(seconds=5)))
    direct.append((None, T0 + dt.timedelta(minutes=50)))
    far = T0 + dt.timedelta(days=2)  # moves the watermark past everything before
    streamed.sort(key=lambda r: r[1])
    direct.sort(key=lambda r: r[1])
    kind = "id bigint, at timestamp"
    read = []
    for name, rows in (("d", direct), ("s", streamed)):
        drop_files(spark, [*rows, (9_000 + len(read), far), (9_010 + len(read), far + dt.timedelta(days=1))], kind,
                   str(tmp_path / name), 6)
        read.append(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).json(str(tmp_path / name)))
    out = str(tmp_path / "out")
    q = delivery.start_delivery_check(read[0].withColumnRenamed("at", "d_at"), read[1].withColumnRenamed("at", "s_at"),
                                      "id", "d_at", "s_at", out, str(tmp_path / "ck"), trigger={"availableNow": True})
    assert q.awaitTermination(240)
    got = sorted(((r.id, r.status, r.latency_seconds) for r in spark.read.parquet(out).collect()
                  if r.id is None or r.id < 9_000), key=str)
    want = gold.compare_deliveries(spark.createDataFrame(direct, "id bigint, d_at timestamp"),
                                   spark.createDataFrame(streamed, "id bigint, s_at timestamp"), "id", "d_at", "s_at")
    assert got == sorted(((r.id, r.status, r.latency_seconds) for r in want.collect()), key=str)
    assert {s for _, s, _ in got} == {"both", "only_direct", "only_streamed"}


def test_signals_of_closed_bars_equal_batch_over_a_restart(spark, tmp_path):
    ticks = V.ticks(spark, SF_ORACLE).withColumn("ts", F.col("ts").cast("timestamp")).cache()
    cut = ticks.selectExpr("percentile_approx(unix_micros(ts), 0.5)").first()[0]
    src, out, ck = str(tmp_path / "ticks"), str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        q = live.start_live_signals(
            spark, lambda s: s.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(src),
            out, ck, width="1 hour", tiebreak="event_id", trigger={"availableNow": True})
        assert q.awaitTermination(240)
        return q

    (ticks.where(F.unix_micros("ts") < cut).repartitionByRange(2, "ts").sortWithinPartitions("ts")
     .write.mode("append").parquet(src))
    aged(src)
    run()
    first = spark.read.parquet(out).count()
    later = str(tmp_path / "later")
    ticks.where(F.unix_micros("ts") >= cut).repartitionByRange(2, "ts").sortWithinPartitions("ts").write.parquet(later)
    for i, f in enumerate(sorted(glob.glob(f"{later}/part-*"))):
        os.replace(f, f"{src}/part-9{i}.parquet")
        os.utime(f"{src}/part-9{i}.parquet", (time.time() - 100 + i,) * 2)
    run()  # the state of the first run goes on
    bars = signals.ohlc_bars(ticks, "1 hour", tiebreak="event_id")
    want = signals.zscore(signals.volatility_regime(signals.momentum(signals.gap(signals.volume_spike(bars)))), "n_trades")
    names = ["is_spike", "is_gap", "regime", "avg_prev_volume", "gap", "momentum", "log_return", "volatility", "zscore"]

    def table(df):
        return {(r.symbol, r.window_start): tuple(round(r[n], 9) if isinstance(r[n], float) else r[n] for n in names)
                for r in df.select("symbol", "window_start", *names).collect()}

    got, want = table(spark.read.parquet(out)), table(want)
    assert 0 < first < len(got) == len(want) - 5  # each symbol's last bar is still open
    assert all(want[k] == v for k, v in got.items())
    ticks.unpersist()


def test_open_windows_of_a_stopped_detector_are_in_its_state(spark, tmp_path):
    src, ck = tmp_path / "src", str(tmp_path / "ck")
    src.mkdir()
    t = 1_767_225_600
    lines = [("A", t + 10), ("A", t + 20), ("B", t + 200), ("A", t + 400), ("C", t + 420), ("C", t + 450)]
    (src / "a.json").write_text("\n".join(f'{{"symbol": "{s}", "datetime": {at}}}' for s, at in lines) + "\n")
    session = rocksdb_session(spark)
    q = detector.start_detector(detector.file_event_stream(session, str(src)), str(tmp_path / "sink"), ck,
                                trigger={"availableNow": True})
    q.awaitTermination(120)
    assert glob.glob(f"{ck}/state/0/*/*.changelog") or glob.glob(f"{ck}/state/0/*/*.zip")
    start = dt.datetime.fromtimestamp(t, dt.timezone.utc).replace(tzinfo=None)
    later = start + dt.timedelta(minutes=5)
    got = sorted((r.symbol, r.window_start, r.window_end, r.event_count)
                 for r in detector.open_windows(session, ck).collect())
    # the first window has closed: the watermark (30 s behind the last event) has passed its end
    assert [(s, w, n) for s, w, _, n in got] == [("A", later, 1), ("C", later, 2)]
    assert all(e - w == dt.timedelta(minutes=5) for _, w, e, _ in got)


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(9)
    versions, facts = [], []
    for i in range(300):  # any lengths, overlapping, open, empty, null
        a = T0 + dt.timedelta(seconds=rng.randint(0, 40 * 86400))
        b = rng.choice([None, a, a - dt.timedelta(days=1), *[a + dt.timedelta(seconds=rng.choice(
            [1, 3600, 86400 * 3, 86400 * 70, 86400 * 5000, 86400 * 400_00]))] * 5])
        versions.append((rng.choice(["a", "b", "c", None]), rng.choice([a] * 9 + [None]), b, i))
    for i in range(400):
        facts.append((i, rng.choice(["a", "b", "c", "d", None]),
                      rng.choice([T0 + dt.timedelta(seconds=rng.randint(0, 60 * 86400))] * 12 + [None])))
    facts += [(1000 + i, v[0], t) for i, v in enumerate(versions[:60]) for t in (v[1], v[2])]  # on the bounds
    f = spark.createDataFrame(facts, "id int, k string, t timestamp")
    v = spark.createDataFrame(versions, "k string, f timestamp, u timestamp, n int")
    got = sorted((tuple(r) for r in interval_join(f, v, ["k"], "t", "f", "u", ["n"]).collect()), key=str)
    want = []
    for i, k, t in facts:
        met = [n for vk, a, b, n in versions if t is not None and k is not None and vk == k and a is not None
               and a <= t and (b is None or t < b)]
        want += [(i, k, t, n) for n in met] or [(i, k, t, None)]
    assert got == sorted(want, key=str)


def test_sector_as_of_the_event(spark):
    day = [T0 + dt.timedelta(days=i) for i in range(9)]
    changes = spark.createDataFrame(
        [("s", day[1], "tech", False), ("s", day[3], "energy", False), ("s", day[5], None, True),
         ("s", day[7], "tech", False), (None, day[0], "odd", False)], "k string, at timestamp, sector string, gone boolean")
    facts = spark.createDataFrame([("s", d) for d in day] + [("t", day[4]), (None, day[4])], "k string, t timestamp")
    got = {(r.k, r.t): r.sector for r in gold.sector_as_of(facts, changes, "k", "t", "at", delete_flag="gone").collect()}
    names = ["UNKNOWN", "tech", "tech", "energy", "energy", "UNKNOWN", "UNKNOWN", "tech", "tech"]
    assert [got["s", d] for d in day] == names
    assert got["t", day[4]] == got[None, day[4]] == "UNKNOWN"
