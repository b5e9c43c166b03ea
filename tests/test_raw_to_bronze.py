"""Raw scans, malformed handling, partition pruning and the raw → bronze job
on generated NDJSON / gzip / concatenated files."""

import gzip
import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool import schemas as S
from tidepool.operators.bronze import SchemaDriftError, bronze_news
from tidepool.operators.filters import partition_predicate, split_malformed
from tidepool.plans import bronze_job
from tidepool.sources.archive import read_archive, split_records
from tidepool.sources.raw import read_raw_bars, read_raw_news


def _art(sym, dt, url, key, fetched, **kw):
    rec = {"source": "finnhub", "asset_class": "equity", "dedup_key": key, "fetched_at": fetched,
           "category": "company", "datetime": dt, "headline": f"h-{key}", "id": 1,
           "image": "", "related": sym, "summary": "s", "url": url}
    rec.update(kw)
    return rec


def _write(path, lines, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    body = "\n".join(lines).encode()
    if gz:
        with gzip.open(path, "wb") as f:
            f.write(body)
    else:
        with open(path, "wb") as f:
            f.write(body)


def _news_tree(root):
    base = os.path.join(root, "source=finnhub", "asset_class=equity")
    h1 = os.path.join(base, "symbol=AAPL", "year=2026", "month=06", "day=05", "hour=09", "data.jsonl")
    h2 = os.path.join(base, "symbol=AAPL", "year=2026", "month=06", "day=05", "hour=10", "data.jsonl")
    m1 = os.path.join(base, "symbol=MSFT", "year=2026", "month=06", "day=05", "hour=09", "data.jsonl")
    _write(h1, [json.dumps(_art("AAPL", 1780650000, "u1", "k1", "2026-06-05T09:00:00+00:00")),
                json.dumps(_art("AAPL", 1780650000, "u1", "k1", "2026-06-05T09:00:01+00:00", id=2)),
                json.dumps(_art("AAPL", "14a", "u2", "k2", "2026-06-05T09:00:00+00:00")),
                '{"source": "finnhub", "dedup_key": "k3", "headl'])
    _write(h2, [json.dumps(_art("AAPL", 1780650000, "u1", "k1", "2026-06-05T10:00:00+00:00", id=3,
                                source="Reuters"))])
    _write(m1, [json.dumps(_art("MSFT", 1780560000, "u9", "k9", "2026-06-05T09:00:00+00:00"))])
    return base


def test_raw_news_scan_partitions_and_malformed(spark, tmp_path):
    base = _news_tree(str(tmp_path))
    raw = read_raw_news(spark, base).cache()
    assert set(S.RAW_NEWS_PARTITIONS.fieldNames()) <= set(raw.columns)
    assert raw.count() == 6
    good, bad = split_malformed(raw)
    assert bad.count() == 2  # truncated line + "14a" in a bigint field
    assert good.where(F.col("month") == 6).count() == 4
    # partition predicate prunes the file listing
    plan = raw.where(partition_predicate(["MSFT"], year=2026))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan or "partition" in plan.lower()
    raw.unpersist()


def test_bronze_transform_latest_fetch_wins(spark, tmp_path):
    base = _news_tree(str(tmp_path))
    good, _ = split_malformed(read_raw_news(spark, base).cache())
    out = bronze_news(good, ingestion_ts="2026-06-06 00:00:00")
    rows = {r["dedup_key"]: r for r in out.collect()}
    assert set(rows) == {"k1", "k9"}
    assert rows["k1"]["news_source"] == "Reuters"  # latest fetched_at wins
    assert out.columns == S.BRONZE_NEWS.fieldNames()
    assert rows["k1"]["event_year"] == 2026 and rows["k1"]["event_day"] == 5


def test_bronze_select_fails_on_drift(spark):
    df = spark.createDataFrame([("a",)], "symbol string")
    try:
        bronze_news(df)
    except SchemaDriftError:
        return
    raise AssertionError("expected SchemaDriftError")


def test_bronze_job_batch_and_empty_and_rerun(spark, tmp_path):
    base = _news_tree(str(tmp_path / "raw"))
    bronze = str(tmp_path / "bronze")
    errors = str(tmp_path / "errors")
    assert bronze_job.run_batch(spark, base, bronze, errors_path=errors)
    out = spark.read.parquet(bronze)
    assert out.count() == 2
    assert set(out.columns) >= {"symbol", "event_year", "event_month", "event_day"}
    assert spark.read.json(errors).where(F.col("error_type") == "malformed_json").count() == 2
    # nothing newer than far future → skipped, table unchanged
    assert not bronze_job.run_batch(spark, base, bronze, modified_after="2999-01-01T00:00:00")
    assert spark.read.parquet(bronze).count() == 2


def test_bronze_incremental_available_now(spark, tmp_path):
    base = _news_tree(str(tmp_path / "raw"))
    bronze = str(tmp_path / "bronze")
    ckpt = str(tmp_path / "ckpt")
    q = bronze_job.start_incremental(spark, base, bronze, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(bronze).count() == 2
    # a new file arrives; the rerun picks up only that file
    extra = os.path.join(base, "symbol=NVDA", "year=2026", "month=06", "day=06", "hour=01",
                         "data.jsonl")
    _write(extra, [json.dumps(_art("NVDA", 1780700000, "u5", "k5", "2026-06-06T01:00:00+00:00"))])
    q = bronze_job.start_incremental(spark, base, bronze, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(bronze).count() == 3


def test_raw_bars_path_symbol_wins(spark, tmp_path):
    base = os.path.join(str(tmp_path), "source=alpha_vantage", "asset_class=equity")
    p = os.path.join(base, "symbol=AAPL", "year=2026", "month=06", "day=07", "data.jsonl")
    rec = {"source": "alpha_vantage", "asset_class": "equity", "symbol": "MSFT", "date": "2026-06-05",
           "open": "1", "high": "2", "low": "0.5", "close": "1.5", "volume": "12x",
           "fetched_at": "t", "dedup_key": "k"}
    _write(p, [json.dumps(rec)])
    rows = read_raw_bars(spark, base).collect()
    assert rows[0]["symbol"] == "AAPL" and rows[0]["volume"] == "12x" and rows[0]["month"] == 6


def _split(spark, text, start):
    df = spark.createDataFrame([(line,) for line in text.split("\n")], "value string")
    rows = split_records(df, StructType.fromDDL("a bigint, b bigint, c bigint, d bigint"),
                         record_start=start).collect()
    return ([tuple(x for x in r[:4] if x is not None) for r in rows if r[4] is None],
            [r[4] for r in rows if r[4] is not None])


def test_split_survives_stray_quotes_and_truncated_records(spark):
    start = r'(?=\{"[a-d]"\s*:)'
    assert _split(spark, 'junk " {"a":1}{"b":2}', start) == ([(1,), (2,)], ['junk "'])
    good, bad = _split(spark, '{"a":1}{"b": 2\n{"c":3}\n{"d":4}', start)
    assert good == [(1,), (3,), (4,)] and bad == ['{"b": 2']
    good, bad = _split(spark, '{"a":1} tail\n[{"a":2}]\n5\n{"a":{"x":1}}', start)
    assert good == [(1,), (2,)] and sorted(bad) == ['5', '[', ']', 'tail', '{"a":{"x":1}}']


def test_two_articles_forced_onto_one_key_both_stay(spark):
    rows = [_art("A", 1780650000, "u1", "same", "2026-06-05T09:00:00+00:00"),
            _art("A", 1780650000, "u2", "same", "2026-06-05T09:00:00+00:00"),
            _art("A", 1780650000, "u2", "same", "2026-06-05T10:00:00+00:00", headline="later")]
    raw = spark.createDataFrame([{**r, "symbol": "A"} for r in rows])
    got = {r["url"]: r["headline"] for r in bronze_news(raw).collect()}
    assert got == {"u1": "h-same", "u2": "later"}


def test_a_replay_writes_rows_without_a_date_once(spark, tmp_path):
    base = str(tmp_path / "raw")
    folder = os.path.join(base, "symbol=AAPL", "year=2026", "month=06", "day=05", "hour=09")
    nodate = _art("AAPL", None, None, "k0", "2026-06-05T09:00:00+00:00")
    _write(os.path.join(folder, "a.jsonl"), [
        json.dumps(nodate), json.dumps(_art("AAPL", 1780650000, None, None, "2026-06-05T09:00:00+00:00")),
        "{broken", json.dumps(_art("AAPL", 1780650000, "u", "k1", "2026-06-05T09:00:00+00:00"))])
    bronze = str(tmp_path / "bronze")
    for ck in ("c1", "c2"):  # the second run replays the batch
        bronze_job.start_incremental(spark, base, bronze, str(tmp_path / ck)).awaitTermination(120)
    assert spark.read.parquet(bronze).count() == 3
    # malformed lines are kept beside the table even if nobody asked, and once
    assert spark.read.json(bronze + "_errors").count() == 1


def test_bars_job(spark, tmp_path):
    base = str(tmp_path / "raw")
    rows = [("2026-06-04", "1.5", "k4", "t1"), ("2026-06-05", "2.5", "k5", "t1"), ("2026-06-05", "3.5", "k5", "t2"),
            ("2026-06-05", "9", "other", "t1"), ("bad", "x", "kb", "t1")]
    for i, (day, close, key, at) in enumerate(rows):
        rec = {"source": "s", "asset_class": "equity", "symbol": "AAPL", "date": day, "open": "1", "high": "4",
               "low": "0.5", "close": close, "volume": "12x" if i == 0 else "100", "fetched_at": at, "dedup_key": key}
        _write(os.path.join(base, "symbol=AAPL", "year=2026", "month=06", f"day=0{i + 1}", "d.jsonl"), [json.dumps(rec)])
    out = str(tmp_path / "bars")
    assert bronze_job.run_bars_batch(spark, base, out, ingestion_ts="2026-06-06 00:00:00")
    got = {(r["dedup_key"], str(r["bar_date"]), r["close"], r["volume"]) for r in spark.read.parquet(out).collect()}
    assert got == {("k4", "2026-06-04", 1.5, None), ("k5", "2026-06-05", 3.5, 100), ("other", "2026-06-05", 9.0, 100),
                   ("kb", "None", None, 100)}
    assert not bronze_job.run_bars_batch(spark, base, out, modified_after="2999-01-01T00:00:00")


def test_archive_concatenated_gzip(spark, tmp_path):
    base = os.path.join(str(tmp_path), "source=stream-archive")
    p = os.path.join(base, "year=2026", "month=06", "day=05", "hour=09", "part-0.gz")
    news = {"source": "Reuters", "asset_class": "equity", "symbol": "AAPL", "dedup_key": "k1", "headline": "a {b} \"c\"",
            "datetime": 1780650000}
    tick = {"source": "finnhub_ws", "asset_class": "equity", "symbol": "AAPL", "dedup_key": "k2", "price": 1.5}
    _write(p, [json.dumps(news) + json.dumps(tick) + json.dumps(news)], gz=True)
    recs = read_archive(spark, base).collect()
    assert len(recs) == 3
    assert {r["dedup_key"] for r in recs} == {"k1", "k2"}
    assert all(r["month"] == 6 and r["hour"] == 9 for r in recs)
    assert recs[0]["headline"] == 'a {b} "c"' or recs[1]["headline"] == 'a {b} "c"'
