"""Producer normalisation (P8–P14, F2, F4, S10), keyed NDJSON landing
and key identity with Python's hashlib."""

import hashlib
import json
import os

from pyspark.sql import functions as F

from tidepool.functions import keys
from tidepool.operators import normalize
from tidepool.sinks.files import write_partitioned_ndjson
from tidepool.sources.raw import read_daily_series


def _py_key(*parts):
    return hashlib.sha256("|".join(str(p) for p in parts).encode()).hexdigest()[:16]


def test_key_identity_with_python(spark):
    df = spark.createDataFrame([("AAPL", "2026-06-05", 1780650000, "https://x/1", 1780650000123,
                                 "150.1", "100")],
                               "s string, d string, dt long, url string, t long, p string, v string")
    r = df.select(keys.bar_key("s", "d").alias("bar"), keys.news_key("s", "dt", "url").alias("news"),
                  keys.news_key("s", F.lit(None), F.lit(None)).alias("news_missing"),
                  keys.tick_key("s", "t", "p", "v").alias("tick")).first()
    assert r["bar"] == "7daf671a4dd3c548" == _py_key("AAPL", "2026-06-05")
    assert r["news"] == _py_key("AAPL", 1780650000, "https://x/1")
    assert r["news_missing"] == _py_key("AAPL", 0, "")
    assert r["tick"] == _py_key("AAPL", 1780650000123, 150.1, 100)


def test_ticker_list_and_subject(spark):
    assert keys.parse_ticker_list(" aapl, Msft ,nvda") == ["AAPL", "MSFT", "NVDA"]
    s = spark.createDataFrame([("Y" * 200, 5)], "s string, n long")
    assert len(s.select(keys.alert_subject("s", "n")).first()[0]) == 99


def test_tick_keys_of_any_number_equal_the_producers(spark):
    import random
    rnd = random.Random(1)
    texts = ["0.0005", "12345678.0", "1e16", "9999999999999998.5", "1.5e-5", "0.0001", "0.00099", "-0.0005",
             "10000000.0", "123456789.125", "1e-4", "0", "100", "12345678901234567890", "-7", "150.10", "1e7",
             "0.001", "1234567.891", "1.7e308", "0.0", "-12345678.5", "2.50e3"]
    texts += [repr(rnd.uniform(0, 10 ** rnd.randint(-6, 15))) for _ in range(300)]
    texts += [str(rnd.randint(0, 10 ** 12)) for _ in range(50)]
    df = spark.createDataFrame([(t,) for t in [*texts, "abc", None]], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", keys.python_number("t").alias("n")).collect()}
    for t in texts:
        assert got[t] == str(json.loads(t)), t
    assert got["abc"] == "abc" and got[None] is None
    k = spark.createDataFrame([("0.0005", "12345678.0")], "p string, v string").select(keys.tick_key(
        F.lit("AAPL"), F.lit(1), keys.python_number("p"), keys.python_number("v"))).first()[0]
    assert k == _py_key("AAPL", 1, 0.0005, 12345678.0)


def test_a_poison_number_costs_its_field_only(spark):
    msgs = ['{"type": "trade", "data": [{"s": "A", "p": "abc", "v": 1, "t": 1}, {"s": "A", "p": 2, "v": {}, "t": 2}]}',
            '{"type": "trade", "data": "x"}', "not json"]
    rows = normalize.normalize_ticks(spark.createDataFrame([(m,) for m in msgs], "value string"),
                                     fetched_at=F.lit("x")).collect()
    assert [(r["price"], r["volume"]) for r in rows] == [(None, 1.0), (2.0, None)]


def test_normalize_news_envelope_and_override(spark):
    arts = spark.createDataFrame(
        [("AAPL", 1780650000, "https://x/1", "h1", None),
         ("AAPL", None, None, "h2", "Reuters")],
        "request_symbol string, datetime long, url string, headline string, source string")
    out = normalize.normalize_news(arts, fetched_at=F.lit("2026-06-05T09:00:00+00:00")).collect()
    a, b = sorted(out, key=lambda r: r["headline"])
    assert a["source"] == "finnhub" and a["symbol"] == "AAPL" and a["asset_class"] == "equity"
    assert a["dedup_key"] == _py_key("AAPL", 1780650000, "https://x/1")
    assert b["source"] == "Reuters"  # the article's own field wins
    assert b["dedup_key"] == _py_key("AAPL", 0, "")


def test_normalize_ticks_messages(spark):
    msgs = [json.dumps({"type": "trade", "data": [{"s": "AAPL", "p": 150.10, "v": 100, "t": 1,
                                                   "c": ["1"]},
                                                  {"p": 2, "v": 0.5, "t": 2}]}),
            json.dumps({"type": "ping"}),
            json.dumps({"type": "trade", "data": []}),
            json.dumps({"type": "trade"})]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    rows = normalize.normalize_ticks(df, fetched_at=F.lit("x")).collect()
    assert len(rows) == 2
    r0 = [r for r in rows if r["symbol"] == "AAPL"][0]
    r1 = [r for r in rows if r["symbol"] == "UNKNOWN"][0]
    assert r0["price"] == 150.1 and r0["conditions"] == ["1"]
    assert r1["conditions"] == [] and r1["timestamp_ms"] == 2
    assert r0["dedup_key"] == _py_key("AAPL", 1, 150.1, 100)


def test_daily_series_payloads(spark, tmp_path):
    base = tmp_path / "payloads"
    good = {"Meta Data": {"2. Symbol": "IBM"},
            "Time Series (Daily)": {"2026-06-05": {"1. open": "1.0", "2. high": "2", "3. low": "0.5",
                                                   "4. close": "1.5", "5. volume": "100"},
                                    "2026-06-04": {"1. open": "1.1", "2. high": "2", "3. low": "0.5",
                                                   "4. close": "1.4", "5. volume": "90"}}}
    (base / "symbol=AAPL").mkdir(parents=True)
    (base / "symbol=AAPL" / "p.json").write_text(json.dumps(good, indent=2))
    (base / "symbol=MSFT").mkdir()
    (base / "symbol=MSFT" / "p.json").write_text(json.dumps({"Note": "rate limited"}))
    (base / "symbol=NVDA").mkdir()
    (base / "symbol=NVDA" / "p.json").write_text(json.dumps({"Error": "?"}))
    payloads = read_daily_series(spark, str(base))
    status = {r["symbol"]: r["status"] for r in normalize.classify_payloads(payloads).collect()}
    assert status == {"AAPL": "ok", "MSFT": "rate_limited", "NVDA": "unexpected"}
    bars = normalize.normalize_bars(payloads, fetched_at=F.lit("t")).collect()
    assert len(bars) == 2 and {b["symbol"] for b in bars} == {"AAPL"}
    b = [x for x in bars if x["date"] == "2026-06-05"][0]
    assert (b["open"], b["close"], b["volume"]) == ("1.0", "1.5", "100")
    assert b["dedup_key"] == _py_key("AAPL", "2026-06-05")


def test_partitioned_ndjson_rerun_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "raw")
    df = spark.createDataFrame(
        [("AAPL", "k1", "2026-06-05 09:10:00"), ("MSFT", "k2", "2026-06-05 10:10:00")],
        "symbol string, dedup_key string, t string").withColumn("t", F.to_timestamp("t"))
    write_partitioned_ndjson(df, out, ["symbol"], ts_col="t")
    assert os.path.isdir(os.path.join(out, "symbol=AAPL", "year=2026", "month=06", "day=05",
                                      "hour=09"))
    # rerun for AAPL only: AAPL folder rewritten, MSFT kept
    write_partitioned_ndjson(df.where("symbol = 'AAPL'"), out, ["symbol"], ts_col="t")
    back = spark.read.json(out)
    assert back.count() == 2
    assert sorted(r["dedup_key"] for r in back.collect()) == ["k1", "k2"]


def test_envelope_map_merge_article_wins(spark):
    prev = spark.conf.get("spark.sql.mapKeyDedupPolicy")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    try:
        df = spark.createDataFrame([({"source": "finnhub", "symbol": "AAPL"},
                                     {"source": "Reuters", "url": "u"})],
                                   "env map<string,string>, art map<string,string>")
        m = df.select(normalize.merge_envelope_maps(F.col("env"), F.col("art"))).first()[0]
        assert m == {"source": "Reuters", "symbol": "AAPL", "url": "u"}
    finally:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", prev)


def test_observe_batch_counters(spark, tmp_path):
    from tidepool.operators.summary import observe_batch
    df = spark.createDataFrame([(True, True), (True, False), (False, False)], "ok boolean, new boolean")
    out, obs = observe_batch(df, "ok", "new")
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"records_processed": 2, "alerts_sent": 1, "batch_size": 3}
