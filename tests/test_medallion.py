"""End to end: raw landing → bronze → silver → gold on driver-derived articles."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidepool import schemas as S
from tidepool.operators import gold, windows
from tidepool.plans import bronze_job
from tidepool.plans import driver_views as V
from tidepool.plans.registry import REGISTRY
from tidepool.sinks.files import write_partitioned_ndjson


def test_raw_to_gold(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    arts = V.articles(spark, SF_SMALL).drop("value")
    # K1: land the raw zone by fetch hour, as the news fetcher does
    write_partitioned_ndjson(arts.drop("fetched_ts").withColumn("t", F.col("fetched_at").cast(
        "timestamp")), raw, ["symbol"], ts_col="t")
    # Raw → bronze
    assert bronze_job.run_batch(spark, raw, bronze, ingestion_ts="2024-02-01 00:00:00")
    b = spark.read.parquet(bronze)
    assert set(S.BRONZE_NEWS.fieldNames()) <= set(b.columns) | {"t"}
    assert b.count() == REGISTRY["a5_bronze_count"].build(spark, SF_SMALL).first()["n_rows"]
    # bronze equals the registered bronze query row for row (keys and event days)
    want = REGISTRY["p1_bronze_news"].build(spark, SF_SMALL)
    cols = ["dedup_key", "symbol", "news_source", "event_year", "event_month", "event_day"]
    assert b.select(*cols).exceptAll(want.select(*cols)).count() == 0
    # Silver on bronze (news_source is the publisher)
    silver = gold.silver_dedup(b.select(F.col("news_source").alias("source"), "symbol", "dedup_key",
                                        F.concat_ws("|", "symbol", "published_at", "url").alias("identity"),
                                        "published_at"), ["published_at"])
    assert silver.count() == b.count()
    # A1 + X17: daily article bursts per symbol on bronze → gold
    daily = gold.daily_anomalies(windows.detect_anomalies(b, threshold=1, width="1 day",
                                                          detected_at=False))
    per_day = b.groupBy("symbol", "event_year", "event_month", "event_day").count()
    assert daily.count() == per_day.count()
    assert daily.agg(F.sum("max_event_count")).first()[0] == b.count()
