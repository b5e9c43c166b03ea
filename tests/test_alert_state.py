"""The alerter's job: keys in state, batches by count and age, poison records set aside."""

import base64
import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepool.session import rocksdb_session
from tidepool.sinks.bisect import bisecting_writer
from tidepool.sources.counted import counted_stream
from tidepool.streaming import alerter


def record(symbol, window="2026-06-05 10:00:00", **more):
    body = {"symbol": symbol, "window_start": window, "window_end": window, "event_count": 3, "detected_at": window}
    return json.dumps({"data": base64.b64encode(json.dumps(body | more).encode()).decode()})


def put(folder, name, lines, end="\n", age=0.0):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + end)
    at = time.time() - age
    os.utime(folder / name, (at, at))


def wait_for(done, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if done():
            return True
        time.sleep(0.25)
    return False


def sizes(query):
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_batches_are_cut_at_a_hundred_records_and_leave_after_the_wait(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    # the file's time lies ahead, so waiting counts from when its records were first seen
    put(src, "a.json", [f'{{"n": {i}}}' for i in range(250)], age=-60)

    def start():
        stream = counted_stream(spark, str(src), max_records=100, max_seconds=6)
        return (stream.writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="0.2 seconds").start())

    q = start()
    try:
        assert wait_for(lambda: len(sizes(q)) == 3) and sizes(q) == [100, 100, 50]
        full, rest = [pd.Timestamp(p["timestamp"]) for p in q.recentProgress if p["numInputRows"]][1:3]
        assert (rest - full).total_seconds() >= 6  # what doesn't fill a batch leaves after the wait
        put(src, "b.json", ['{"n": "lone"}'])
        put(src, "old.json", [f'{{"old": {i}}}' for i in range(3)], age=50)  # an older time, still new
        assert wait_for(lambda: sum(sizes(q)) == 254)
    finally:
        q.stop()
    # a restart goes on at the byte after the last record, in a file that has grown
    with open(src / "a.json", "a") as f:
        f.write('{"n": 250}\n{"n": 251}')  # no line end yet
    q = start()
    try:
        assert wait_for(lambda: sum(sizes(q)) == 2)
    finally:
        q.stop()
    got = [r[0] for r in spark.read.parquet(out).select("value").collect()]
    assert len(got) == 256 == len(set(got))
    assert '{"n": 251}' in got


def test_folder_of_a_file_sink_is_read_by_its_log(spark, tmp_path):
    src, sink = tmp_path / "in", tmp_path / "sink"
    put(src, "x.txt", ["one", "two"])
    (spark.readStream.text(str(src)).writeStream.format("text").option("path", str(sink))
     .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(60))
    put(sink, "part-of-a-failed-attempt.txt", ["junk"])
    q = (counted_stream(spark, str(sink), max_seconds=0).writeStream.format("memory").queryName("by_log")
         .trigger(processingTime="0.2 seconds").start())
    try:
        assert wait_for(lambda: spark.table("by_log").count() == 2)
        time.sleep(1)
        assert sorted(r.value for r in spark.table("by_log").collect()) == ["one", "two"]
    finally:
        q.stop()


def test_keys_live_in_state_over_a_restart(spark, tmp_path):
    src, alerts = tmp_path / "src", str(tmp_path / "alerts")

    def start(ttl):
        return alerter.start_alerter(spark, str(src), alerts, str(tmp_path / "ck"), str(tmp_path / "summary"),
                                     trigger={"processingTime": "0.2 seconds"}, max_seconds=0.1, ttl_seconds=ttl)

    def stored():
        try:
            return sorted((r.symbol, r.event_count) for r in spark.read.parquet(alerts).collect())
        except Exception:
            return []

    hot = [record("HOT", event_count=i) for i in range(40)]
    put(src, "1.json", [record("A"), record("A", event_count=9), "no json", json.dumps({"data": "!!"}), *hot])
    q = start(3600)
    try:
        assert wait_for(lambda: stored() == [("A", 3), ("HOT", 0)])
    finally:
        q.stop()
    put(src, "2.json", [record("A"), record("B")])
    q = start(3600)  # A is known although nothing stored is read: its key came back with the checkpoint
    try:
        assert wait_for(lambda: len(stored()) == 3)
        assert stored() == [("A", 3), ("B", 3), ("HOT", 0)]
    finally:
        q.stop()
    plan = [p for p in q.recentProgress if p["stateOperators"]][-1]
    assert plan["stateOperators"][0]["operatorName"] == "transformWithStateInPySparkExec"
    s = {r["batch_id"]: r for r in spark.read.json(str(tmp_path / "summary")).collect()}
    assert sum(r["batch_size"] for r in s.values()) == 46
    assert sum(r["records_processed"] for r in s.values()) == 44
    assert sum(r["alerts_sent"] for r in s.values()) == 3
    assert spark.read.parquet(alerts).where("symbol = 'A'").first()["dedup_key"] == "A|2026-06-05 10:00:00"


def test_a_key_is_new_again_after_its_expiry(spark, tmp_path):
    src, alerts = tmp_path / "src", str(tmp_path / "alerts")
    put(src, "1.json", [record("A")])
    q = alerter.start_alerter(spark, str(src), alerts, str(tmp_path / "ck"), max_seconds=0.1, ttl_seconds=4,
                              trigger={"processingTime": "0.2 seconds"})
    try:
        assert wait_for(lambda: len(sizes(q)) == 1)
        time.sleep(6)
        put(src, "2.json", [record("A")])
        assert wait_for(lambda: len(sizes(q)) == 2)
        assert wait_for(lambda: spark.read.parquet(alerts).count() == 2)
    finally:
        q.stop()


def landed(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect()) if os.path.exists(path) else []


def poisoned(path, poison, order=None):
    """A file sink that fails on rows of ``poison``."""
    def write(rows, batch_id, part):
        order is not None and order.append(part)
        bad = F.array_contains(F.lit(sorted(poison) or [-1]), F.col("id"))
        (rows.withColumn("id", F.when(bad, F.raise_error(F.lit("poison")).cast("bigint")).otherwise(F.col("id")))
         .withColumn("part", F.lit(part)).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "part").parquet(path))
    return write


def test_one_poison_row_is_set_aside_and_all_others_land_once_in_order(spark, tmp_path):
    out, errors, order = str(tmp_path / "out"), str(tmp_path / "err"), []
    run = bisecting_writer(poisoned(out, {37}, order), str(tmp_path / "ledger"), errors, ["key", "id"])
    batch = spark.range(64).selectExpr("id", "concat('k', id % 3) as key")
    run(batch, 4)
    assert landed(spark, out) == [i for i in range(64) if i != 37]
    dead = spark.read.json(errors).collect()
    assert [(r["id"], r["tries"], r["error_type"], r["batch_id"]) for r in dead] == [(37, 5, "write_failed", 4)]
    assert "poison" in dead[0]["error"]
    parts = {r.id: r.part for r in spark.read.parquet(out).collect()}
    for k in range(3):  # ranges were written in the order of the rows of a key
        at = [order.index(parts[i]) for i in range(64) if i % 3 == k and i != 37]
        assert at == sorted(at)
    single = next(p for p in order if order.count(p) == 5)
    assert single.split("-")[0] == single.split("-")[1]
    run(batch, 4)  # a replay adds nothing
    assert landed(spark, out) == [i for i in range(64) if i != 37]
    assert spark.read.json(errors).count() == 1


def test_a_batch_that_writes_well_leaves_no_ledger_and_an_empty_one_lands(spark, tmp_path):
    out = str(tmp_path / "out")
    run = bisecting_writer(poisoned(out, set()), str(tmp_path / "ledger"), str(tmp_path / "err"), ["id"])
    run(spark.range(5), 1)
    run(spark.range(0), 2)
    assert landed(spark, out) == list(range(5))
    assert not (tmp_path / "ledger").exists() and not (tmp_path / "err").exists()


def test_a_lost_driver_goes_on_with_the_tries_it_had(spark, tmp_path):
    out, errors = str(tmp_path / "out"), str(tmp_path / "err")
    inner, seen = poisoned(out, {2, 9}), []

    def dies(rows, batch_id, part):
        seen.append(part)
        if len(seen) == 12:
            raise KeyboardInterrupt  # not an error of the sink
        inner(rows, batch_id, part)

    batch = spark.range(12)
    make = lambda w: bisecting_writer(w, str(tmp_path / "ledger"), errors, ["id"])
    with pytest.raises(KeyboardInterrupt):
        make(dies)(batch, 0)
    make(lambda r, b, p: (seen.append(p), inner(r, b, p)))(batch, 0)
    assert landed(spark, out) == [i for i in range(12) if i not in (2, 9)]
    assert sorted((r["id"], r["tries"]) for r in spark.read.json(errors).collect()) == [(2, 5), (9, 5)]
    assert seen.count("all") == 1  # the replay reads the ledger, not the batch


def test_an_alert_that_cannot_be_sent_does_not_stop_the_others(spark, tmp_path):
    src, alerts = tmp_path / "src", str(tmp_path / "alerts")
    put(src, "1.json", [record(f"S{i}") for i in range(6)])
    store = alerter.store_alerts(alerts)

    def send(rows, batch_id, part):
        if rows.where("symbol = 'S4'").count():
            raise ValueError("refused")
        store(rows, batch_id, part)

    q = alerter.start_alerter(spark, str(src), alerts, str(tmp_path / "ck"), send=send, tries=2,
                              trigger={"availableNow": True})
    q.awaitTermination(120)
    assert sorted(r.symbol for r in spark.read.parquet(alerts).collect()) == ["S0", "S1", "S2", "S3", "S5"]
    assert [(r.symbol, r.tries) for r in spark.read.json(alerts + "_errors").collect()] == [("S4", 2)]


def test_rocksdb_is_set_on_the_jobs_session_only(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    own = rocksdb_session(spark)
    assert "RocksDB" in own.conf.get(key) and spark.conf.get(key) == before
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
