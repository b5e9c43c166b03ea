"""A stream archive of several kinds of record: cut by the reader, routed by shape."""

import gzip
import json
import os

from pyspark.sql import functions as F

from tidepool import schemas as S
from tidepool.sources.archive import archive_lines, land_mixed, read_archive, read_kind, route_records, split_records


def news(i, **more):
    return json.dumps({"source": "finnhub", "asset_class": "equity", "symbol": "A", "dedup_key": f"n{i}",
                       "headline": f"h{i}", "datetime": i, "fetched_at": "t"} | more)


def tick(i, **more):
    return json.dumps({"source": "finnhub_ws", "asset_class": "equity", "symbol": "B", "price": i + 0.5, "volume": 2,
                       "timestamp_ms": i, "conditions": ["1", "2"], "fetched_at": "t", "dedup_key": f"t{i}"} | more)


def test_news_and_ticks_of_one_archive_become_two_typed_tables(spark, tmp_path):
    for hour, texts in ((1, [news(1) + tick(1) + tick(2), "junk" + news(2)]), (2, [tick(3) + "\n" + news(3) + '{"x": 1}'])):
        d = tmp_path / "a" / "year=2026" / "month=03" / "day=05" / f"hour={hour:02d}"
        os.makedirs(d)
        for n, t in enumerate(texts):
            with gzip.open(d / f"f{n}.gz", "wt") as f:
                f.write(t)
    out = str(tmp_path / "out")
    for _ in range(2):  # a rerun replaces the same folders
        land_mixed(spark, str(tmp_path / "a"), out)
    ticks = read_kind(spark, out, "ticks", S.RAW_TICK_DATA)
    assert dict(ticks.dtypes)["price"] == "double" and dict(ticks.dtypes)["conditions"] == "array<string>"
    assert sorted((r.dedup_key, r.price, r.timestamp_ms, r.hour) for r in ticks.collect()) == [
        ("t1", 1.5, 1, 1), ("t2", 2.5, 2, 1), ("t3", 3.5, 3, 2)]
    articles = read_kind(spark, out, "news", S.RAW_ARCHIVE_DATA)
    assert sorted((r.dedup_key, r.headline, r.datetime) for r in articles.collect()) == [
        ("n1", "h1", 1), ("n2", "h2", 2), ("n3", "h3", 3)]
    left = spark.read.parquet(out).where("kind in ('bad', 'other')").select("kind", "record").collect()
    assert sorted(tuple(r) for r in left) == [("bad", "junk"), ("other", '{"x": 1}')]
    plan = ticks.select("price")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<price:double>" in plan


def test_shapes_wrong_types_and_odd_records(spark):
    texts = [tick(1, price="no number"), tick(2, timestamp_ms=None), news(1, headline=None), news(2, price=1),
             news(3, datetime="soon"), '{"source": "x", "asset_class": "y", "a": {"b": {"c": {"d": {"e": []}}}}}',
             news(4)[:-3], "[1, 2]", "", "   ", None, news(5) + news(5), '{"source":"x","asset_class":1,"source":2}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = sorted((r.i, r.kind, r.dedup_key, r.price, r.datetime) for r in route_records(df, keep=["i"]).collect())
    assert got == [(0, "ticks", "t1", None, None), (1, "other", None, None, None), (2, "other", None, None, None),
                   (3, "news", "n2", 1.0, 2), (4, "news", "n3", None, None), (5, "other", None, None, None),
                   (6, "bad", None, None, None), (7, "bad", None, None, None), (11, "news", "n5", None, 5),
                   (11, "news", "n5", None, 5), (12, "bad", None, None, None)]


def test_a_deeply_nested_record_is_good(spark):
    deep = '{"source":"s","asset_class":"e","symbol":"A","headline":"x","extra":{"a":{"b":{"c":{"d":1}}}}}'
    df = spark.createDataFrame([(deep + deep + " junk",)], "value string")
    got = sorted((r.symbol or "", r[S.CORRUPT_COL] or "") for r in split_records(df, S.RAW_ARCHIVE_DATA).collect())
    assert ("A", "") in got


def test_a_file_without_line_ends_is_read_record_by_record(spark, tmp_path):
    n = 60_000
    with open(tmp_path / "one.json", "w") as f:
        f.write(" lead " + "".join(news(i, summary="s" * 200) for i in range(n)))
    lines = archive_lines(spark, str(tmp_path))
    longest, count = lines.agg(F.max(F.length("value")), F.count("*")).first()
    assert longest < 500 and count == n + 1
    recs = read_archive(spark, str(tmp_path), partition_schema=S.RAW_ARCHIVE_PARTITIONS)
    assert recs.where("dedup_key is not null").agg(F.countDistinct("dedup_key")).first()[0] == n
    assert [r[0] for r in recs.where(f"{S.CORRUPT_COL} is not null").select(S.CORRUPT_COL).collect()] == ["lead"]
