"""One named test per semantic trap of SURVEY §1.3 not covered elsewhere."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from tidepool.functions import timecols
from tidepool.operators.windows import tumbling_count
from tidepool.plans import bronze_job
from tidepool.plans.registry import REGISTRY
from tidepool.sources.raw import read_raw_bars


def test_trap05_count_star_counts_duplicates(spark):
    df = spark.createDataFrame([("A", "k1", 60), ("A", "k1", 61), ("A", "k2", 62)],
                               "symbol string, dedup_key string, datetime long")
    df = df.withColumn("published_at", timecols.epoch_seconds_to_timestamp("datetime"))
    assert tumbling_count(df).first()["event_count"] == 3


def test_trap16_bad_epoch_text_is_null_not_an_error(spark):
    df = spark.createDataFrame([("14a",), ("60",)], "d string")
    got = [r[0] for r in df.select(timecols.epoch_seconds_to_timestamp("d")).collect()]
    assert got[0] is None and got[1] is not None


@pytest.mark.parametrize("name", ["a1_anomaly_1h", "p_time_columns", "d4_first_seen_ttl",
                                  "x12_asof_view_before_purchase", "x15_delivery_compare"])
def test_trap17_results_do_not_depend_on_session_zone(spark, name):
    q = REGISTRY[name]
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        utc = sorted(map(tuple, q.build(spark, SF_ORACLE).collect()))
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        other = sorted(map(tuple, q.build(spark, SF_ORACLE).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert utc == other


def test_trap18_bars_fail_fast_on_malformed(spark, tmp_path):
    p = tmp_path / "symbol=AAPL" / "year=2026" / "month=06" / "day=05"
    p.mkdir(parents=True)
    (p / "data.jsonl").write_text('{"symbol": "AAPL", "date": "2026-06-05"}\n{"symbol": \n')
    with pytest.raises(Exception):
        read_raw_bars(spark, str(tmp_path)).collect()


def test_trap02_replayed_batch_writes_nothing_twice(spark, tmp_path):
    raw = tmp_path / "raw" / "symbol=AAPL" / "year=2026" / "month=06" / "day=05" / "hour=09"
    raw.mkdir(parents=True)
    rec = {"source": "x", "dedup_key": "k1", "datetime": 1780650000, "headline": "h",
           "fetched_at": "2026-06-05T09:00:00+00:00", "id": 1}
    (raw / "a.jsonl").write_text(json.dumps(rec) + "\n")
    bronze = str(tmp_path / "bronze")
    q = bronze_job.start_incremental(spark, str(tmp_path / "raw"), bronze, str(tmp_path / "ck1"))
    q.awaitTermination(120)
    # same file seen again by a fresh checkpoint = a replay of an already-written batch
    q = bronze_job.start_incremental(spark, str(tmp_path / "raw"), bronze, str(tmp_path / "ck2"))
    q.awaitTermination(120)
    assert spark.read.parquet(bronze).count() == 1
    assert os.path.isdir(os.path.join(bronze, "symbol=AAPL"))


def test_trap02_replay_check_with_catalog_table(spark, tmp_path):
    raw = tmp_path / "raw" / "symbol=MSFT" / "year=2026" / "month=06" / "day=05" / "hour=09"
    raw.mkdir(parents=True)
    rows = [{"source": "x", "dedup_key": f"k{i}", "datetime": 1780650000 + 86400 * i, "headline": "h",
             "fetched_at": "2026-06-05T09:00:00+00:00", "id": i} for i in range(3)]
    (raw / "a.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    bronze = str(tmp_path / "bronze")
    for ck in ("ck1", "ck2"):  # the second run replays the same file
        q = bronze_job.start_incremental(spark, str(tmp_path / "raw"), bronze, str(tmp_path / ck),
                                         table="bronze_replay_t")
        q.awaitTermination(120)
    assert spark.table("bronze_replay_t").count() == 3
    assert spark.table("bronze_replay_t").select("event_day").distinct().count() == 3
    spark.sql("DROP TABLE bronze_replay_t")
