"""Structured Streaming: the detector equals the batch query, late rows are
dropped, restarts resume, the alerter dedups, the archive lands files."""

import base64
import glob
import json
import os
import time

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from tidepool.plans.registry import REGISTRY
from tidepool.streaming import alerter, archive, detector


def _wait_for(done, seconds=30):
    """Listener events arrive a moment after the batch."""
    end = time.time() + seconds
    while not done() and time.time() < end:
        time.sleep(0.2)


def _detector_files(folder, n_files=3):
    ev = pd.read_parquet(f"{SF_ORACLE}/events.parquet").sort_values(["ts", "event_id"])
    ev["datetime"] = (ev["ts"] - pd.Timestamp("1970-01-01")) // pd.Timedelta("1s")
    os.makedirs(folder, exist_ok=True)
    size = (len(ev) + n_files - 1) // n_files
    t0 = time.time() - 1000
    for i in range(n_files):
        part = ev.iloc[i * size:(i + 1) * size]
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as f:
            for r in part.itertuples():
                f.write(json.dumps({"symbol": r.event_type, "headline": "h", "dedup_key": str(r.event_id),
                                    "fetched_at": "x", "datetime": int(r.datetime)}) + "\n")
        os.utime(path, (t0 + i, t0 + i))
    return ev


def test_detector_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    _detector_files(src)
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    stream = detector.file_event_stream(spark, src, max_files_per_trigger=1)
    totals = detector.InputTotals()
    spark.streams.addListener(totals)
    q = detector.start_detector(stream, sink, ckpt, threshold=3, width="5 minutes",
                                trigger={"availableNow": True})
    q.awaitTermination(300)
    _wait_for(lambda: totals.of(q)["rows"] == 10000)
    assert totals.of(q) == {"rows": 10000, "null_event_time": 0, "dropped_late": 0}
    got = spark.read.json(sink)
    batch = REGISTRY["a1_anomaly_5m"].build(spark, SF_ORACLE)
    assert got.count() == batch.count() == 62
    vals = got.select(F.get_json_object("value", "$.symbol").alias("s"),
                      F.get_json_object("value", "$.event_count").cast("long").alias("n"))
    assert vals.agg(F.sum("n")).first()[0] == batch.agg(F.sum("event_count")).first()[0]
    assert set(r["key"] for r in got.select("key").collect()) <= {
        "click", "view", "purchase", "signup", "error"}
    # the record's window_start text is the alert-key text of the batch path
    from tidepool.functions import keys as K
    streamed = got.select(F.concat_ws("|", F.get_json_object("value", "$.symbol"),
                                      F.get_json_object("value", "$.window_start")).alias("k"))
    batch_keys = batch.select(K.alert_key(F.col("symbol"),
                                          F.col("window_start").cast("timestamp")).alias("k"))
    assert streamed.exceptAll(batch_keys).count() == 0

    # a late file (an hour before the watermark) adds nothing; restart resumes
    late = os.path.join(src, "part-late.json")
    with open(late, "w") as f:
        for i in range(5):
            f.write(json.dumps({"symbol": "LATE", "datetime": 1704067200 + i}) + "\n")
        f.write('{"symbol": "BAD", "datetime": \n')
    q = detector.start_detector(detector.file_event_stream(spark, src), sink, ckpt,
                                trigger={"availableNow": True})
    q.awaitTermination(300)
    assert spark.read.json(sink).where(F.col("key") == "LATE").count() == 0
    assert spark.read.json(sink).count() == 62
    # counted after the map-side partial aggregate: 5 late rows in one window → 1
    # (a restarted query keeps its id: totals go on; the malformed line never reaches the window)
    _wait_for(lambda: totals.of(q)["dropped_late"] == 1)
    assert totals.of(q) == {"rows": 10005, "null_event_time": 0, "dropped_late": 1}
    spark.streams.removeListener(totals)
    # waiting for the detector waits for its error output, which is never off
    assert [json.loads(r["value"])["_corrupt_record"] for r in spark.read.text(sink + "_errors").collect()] == [
        '{"symbol": "BAD", "datetime": ']


def test_detector_null_time_and_threshold_edges(spark):
    rows = [("A", 600), ("A", 601), ("A", 899), ("B", 600), ("B", 601), ("A", None), (None, 610),
            (None, 611), (None, 612), ("C", 900), ("C", 900), ("C", 1199)]
    df = spark.createDataFrame(rows, "symbol string, datetime long")
    out = detector.detector(df, threshold=3, width="5 minutes", watermark=None)
    got = {(r["symbol"], r["event_count"]) for r in out.collect()}
    # exactly three kept, two dropped, null time dropped, null symbol kept, edge 900 opens a window
    assert got == {("A", 3), (None, 3), ("C", 3)}


def _b64(obj):
    return base64.b64encode(json.dumps(obj).encode()).decode()


def test_alerter_first_seen_and_summary(spark, tmp_path):
    src = tmp_path / "anoms"
    src.mkdir()
    a = {"symbol": "AAPL", "window_start": "2026-06-05 10:00:00", "window_end": "2026-06-05 10:05:00",
         "event_count": 4, "detected_at": "2026-06-05 10:05:31"}
    b = dict(a, event_count=7)  # same key, other count → suppressed
    c = dict(a, symbol=None)    # key text "None|..."
    long_sym = dict(a, symbol="X" * 120)
    lines1 = [_b64(a), _b64(b), "!!notbase64!!", base64.b64encode(b"[1, 2]").decode(), _b64(c)]
    lines2 = [_b64(a), _b64(long_sym)]
    for i, lines in enumerate((lines1, lines2)):
        p = src / f"batch-{i}.txt"
        p.write_text("\n".join(json.dumps({"data": x}) for x in lines) + "\n")
        os.utime(p, (time.time() - 100 + i, time.time() - 100 + i))
    alerts, summ, ckpt = str(tmp_path / "alerts"), str(tmp_path / "summary"), str(tmp_path / "ck")
    q = alerter.start_alerter(spark, str(src), alerts, ckpt, summ, trigger={"availableNow": True},
                              max_files_per_trigger=1)
    q.awaitTermination(300)
    out = spark.read.parquet(alerts)
    keys = sorted(r["dedup_key"] for r in out.collect())
    assert keys == ["AAPL|2026-06-05 10:00:00", "None|2026-06-05 10:00:00",
                    "X" * 120 + "|2026-06-05 10:00:00"]
    assert all(len(r["subject"]) <= 99 for r in out.collect())
    s = {r["batch_id"]: r for r in spark.read.json(summ).collect()}
    assert (s[0]["records_processed"], s[0]["alerts_sent"], s[0]["batch_size"]) == (3, 2, 5)
    assert (s[1]["records_processed"], s[1]["alerts_sent"], s[1]["batch_size"]) == (2, 1, 2)
    body = json.loads(out.where(F.col("symbol") == "AAPL").first()["body"])
    assert body["event_count"] == 4


def test_a_replayed_alert_batch_reports_the_alerts_it_sent(spark, tmp_path):
    alerts, summ = str(tmp_path / "alerts"), str(tmp_path / "summary")
    a = {"symbol": "AAPL", "window_start": "2026-06-05 10:00:00", "event_count": 4}
    batch = spark.createDataFrame([(_b64(a),), ("junk",)], "data string")
    run = alerter.alerts_foreach_batch(alerts, summ)
    for _ in range(2):  # the second time the alerts are stored, the summary may be missing
        run(batch, 7)
    assert spark.read.schema(alerter.STORED_ALERT).parquet(alerts).count() == 1
    s = spark.read.json(summ).first()
    assert (s["records_processed"], s["alerts_sent"], s["batch_size"]) == (1, 1, 2)


def test_alerter_keyed_state(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i, keys in enumerate((["k1", "k1", "k2"], ["k1", "k3"])):
        f = src / f"{i}.json"
        f.write_text("\n".join(json.dumps({"dedup_key": k, "body": f"b{i}{j}"}) for j, k in enumerate(keys)))
        os.utime(f, (time.time() - 100 + i, time.time() - 100 + i))
    stream = (spark.readStream.schema("dedup_key string, body string").option("maxFilesPerTrigger", 1)
              .json(str(src)))
    out = str(tmp_path / "out")
    # a state with a clock asks for batches without data, which an availableNow run would wait for
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    q = (alerter.dedup_keyed_state(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert q.awaitTermination(180)
    assert sorted((r["dedup_key"], r["body"]) for r in spark.read.parquet(out).collect()) == [
        ("k1", "b00"), ("k2", "b02"), ("k3", "b11")]


def test_alerter_event_time_dedup(spark, tmp_path):
    rows = [("k1", "2026-06-05 10:00:00"), ("k1", "2026-06-05 10:00:00"), ("k2", "2026-06-05 11:00:00"),
            ("k3", "no time"), ("k3", "no time")]
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps({"dedup_key": k, "window_start": w})
                                          for k, w in rows))
    stream = spark.readStream.schema("dedup_key string, window_start string").json(str(src))
    q = (alerter.dedup_event_time(stream).writeStream.format("memory").queryName("dedup_et")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.table("dedup_et").count() == 3  # a poison time is no error


def test_archive_lands_gzip_by_hour(spark, tmp_path):
    src = tmp_path / "recs"
    src.mkdir()
    (src / "r.txt").write_text('{"a": 1}\n{"a": 2}\n')
    out, ckpt = str(tmp_path / "archive"), str(tmp_path / "ack")
    q = archive.start_archive(spark.readStream.text(str(src)), out, ckpt,
                              trigger={"availableNow": True})
    q.awaitTermination(120)
    files = glob.glob(f"{out}/year=*/month=*/day=*/hour=*/*.gz")
    assert files
    assert spark.read.json(out).count() == 2


def test_signals_on_a_tick_stream_equal_batch(spark, tmp_path):
    from tidepool.operators.signals import latest_quote, ohlc_bars
    from tidepool.plans import driver_views as V
    from tidepool.streaming import signals as ssig
    ticks = V.ticks(spark, SF_ORACLE).withColumn("ts", F.col("ts").cast("timestamp"))
    src = str(tmp_path / "ticks")
    ticks.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(src)
    t0 = time.time() - 1000  # the file source reads oldest first: age the files in time order
    for i, f in enumerate(sorted(glob.glob(f"{src}/part-*.parquet"))):
        os.utime(f, (t0 + i, t0 + i))
    stream = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = ssig.start_bars(stream, str(tmp_path / "bars"), str(tmp_path / "ck1"), width="1 hour",
                        tiebreak="event_id", trigger={"availableNow": True})
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "bars"))
    want = ohlc_bars(ticks, "1 hour", tiebreak="event_id")
    # every closed bar equals the batch bar; only the last (still open) bar is missing
    assert got.count() == want.count() - 5
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    quotes = str(tmp_path / "quotes")
    q = ssig.start_latest_quotes(stream, str(tmp_path / "ck2"), path=quotes, tiebreak="event_id",
                                 trigger={"availableNow": True})
    q.awaitTermination(300)
    live = {r["symbol"]: r["event_id"] for r in spark.read.parquet(quotes).collect()}
    assert spark.read.parquet(quotes).count() == len(live)
    batch = {r["symbol"]: r["event_id"] for r in latest_quote(ticks, tiebreak="event_id").collect()}
    assert live == batch


def test_file_stream_starts_at_latest(spark, tmp_path):
    src = tmp_path / "recs"
    src.mkdir()
    old, new = src / "old.json", src / "new.json"
    old.write_text(json.dumps({"symbol": "OLD", "datetime": 1}) + "\n")
    new.write_text(json.dumps({"symbol": "NEW", "datetime": 2}) + "\n")
    now = time.time()
    os.utime(old, (now - 7200, now - 7200))
    os.utime(new, (now - 60, now - 60))
    cut = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(now - 3600))
    s = detector.file_event_stream(spark, str(src), start_after=cut)
    q = s.writeStream.format("memory").queryName("latest_only").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = [json.loads(r["value"])["symbol"] for r in spark.table("latest_only").collect()]
    assert got == ["NEW"]


def test_dual_write_stream_lands_both_sinks(spark, tmp_path):
    from tidepool.sinks.publish import batch_scoped_writer
    src = tmp_path / "in"
    src.mkdir()
    for i in range(2):
        p = src / f"r{i}.txt"
        p.write_text(f'{{"n": {i}}}\n{{"n": {i + 10}}}\n')
        os.utime(p, (time.time() - 100 + i, time.time() - 100 + i))
    files, stream_copy = str(tmp_path / "files"), str(tmp_path / "stream")
    q = archive.start_dual_write(
        spark.readStream.option("maxFilesPerTrigger", 1).text(str(src)), str(tmp_path / "ck"),
        [batch_scoped_writer(files), batch_scoped_writer(stream_copy, fmt="parquet")],
        trigger={"availableNow": True})
    q.awaitTermination(120)
    assert spark.read.json(files).count() == 4
    assert spark.read.parquet(stream_copy).select("batch_id").distinct().count() == 2
