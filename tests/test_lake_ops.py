"""Lake operations: merge on plain Parquet (X19), silver append (X10), CTAS
(K10), dual write (K7), keyed publish (K4), Parquet archive (X16), and
brute-force checks of the custom operators (D3, D4, as-of)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidepool.operators import cdc, dedup, gold
from tidepool.operators.joins import asof_join
from tidepool.sinks.files import create_table_as
from tidepool.sinks.publish import (batch_scoped_writer, call_report, dual_write, keyed_records,
                                    publish_calls)
from tidepool.streaming import archive


def test_merge_partitions_upserts_only_touched(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, "a", 1, "2026-06-01"), (2, "b", 1, "2026-06-01"),
                                  (3, "c", 1, "2026-06-02")], "id int, v string, seq int, day string")
    cdc.merge_partitions(spark, path, base, ["id"], ["seq"], ["day"])
    upd = spark.createDataFrame([(1, "a2", 2, "2026-06-01"), (4, "d", 1, "2026-06-01")],
                                "id int, v string, seq int, day string")
    cdc.merge_partitions(spark, path, upd, ["id"], ["seq"], ["day"])
    got = {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {1: "a2", 2: "b", 3: "c", 4: "d"}


def test_merge_moves_keys_and_removes_emptied_partitions(spark, tmp_path):
    import os

    from tidepool.session import checkpoint_dir
    path = str(tmp_path / "t")
    kind = "id int, v string, seq int, part string"
    base = spark.createDataFrame([(1, "a", 1, "A"), (2, "b", 1, "B"), (3, "c", 1, "C"), (4, "n", 1, None),
                                  (None, "k", 1, "B")], kind)
    cdc.merge_partitions(spark, path, base, ["id"], ["seq"], ["part"])
    untouched = os.listdir(f"{path}/part=C")
    upd = spark.createDataFrame([(1, "a2", 2, "B"), (4, "n2", 2, None), (None, "k2", 2, "D"),
                                 (2, "late", 0, "B")], kind)
    cdc.merge_partitions(spark, path, upd, ["id"], ["seq"], ["part"])
    got = sorted(((r["id"], r["v"], r["part"]) for r in spark.read.parquet(path).collect()), key=str)
    assert got == sorted([(1, "a2", "B"), (2, "b", "B"), (3, "c", "C"), (4, "n2", None), (None, "k2", "D")], key=str)
    assert not os.path.exists(f"{path}/part=A") and os.listdir(f"{path}/part=C") == untouched
    scratch = checkpoint_dir(spark).removeprefix("file:")
    assert not [f for f in os.listdir(scratch) if f.startswith("merge_")]


def test_silver_append_new_keys(spark):
    kind = "source string, symbol string, dedup_key string, identity string"
    existing = spark.createDataFrame([("s", "A", "k1", "x"), ("s", None, "k5", "y")], kind)
    incoming = spark.createDataFrame([("s", "A", "k1", "x"), ("s", "A", "k2", "z"), ("t", "A", "k1", "x"),
                                      ("s", None, "k5", "y"), ("s", "A", "k1", "other")], kind)
    new = gold.append_new_keys(existing, incoming).collect()
    # a null symbol is found again; equal 64-bit keys of different content stay apart
    assert sorted((r["source"], r["dedup_key"], r["identity"]) for r in new) == [
        ("s", "k1", "other"), ("s", "k2", "z"), ("t", "k1", "x")]


def test_ctas_with_location(spark, tmp_path):
    spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string").createOrReplaceTempView("src_v")
    t = create_table_as(spark, "gold_ctas_t", str(tmp_path / "gold"), "SELECT * FROM src_v WHERE id > 1")
    assert t.count() == 1
    spark.sql("DROP TABLE gold_ctas_t")


def test_dual_write_is_idempotent_per_batch(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    writers = [batch_scoped_writer(a), batch_scoped_writer(b, fmt="parquet")]
    dual_write(df, 7, writers)
    dual_write(df, 7, writers)  # replay of batch 7
    assert spark.read.json(a).count() == 2 and spark.read.parquet(b).count() == 2


def test_keyed_records_are_ordered_and_a_hot_key_is_split(spark):
    rows = [("HOT", i) for i in range(2000)] + [(None, i) for i in range(50)] + [("A", i) for i in range(50)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "symbol string, t int")
    parts = keyed_records(df, "symbol", ["t"], num_partitions=8).rdd.glom().collect()
    flat = [(r["key"], r["t"]) for p in parts for r in p]
    assert flat == sorted((s or "UNKNOWN", t) for s, t in rows)  # order holds across partitions
    assert sum(any(r["key"] == "HOT" for r in p) for p in parts) >= 4


def test_publish_calls_brute_force(spark):
    rnd = random.Random(2)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice(["A", "B", None]), t0 + dt.timedelta(minutes=rnd.randint(0, 600)), i,
             rnd.choice([None, None, "E1", "E2"])) for i in range(700)]
    rows += [("A", None, 9000, "E1")]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long, error_code string")
    calls = publish_calls(df, "ts", ["id"], chunk=50).cache()
    want = {}
    for key in ("A", "B", None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or t0, r[2]))
        want |= {r[2]: i // 50 for i, r in enumerate(own)}
    assert {r["id"]: r["chunk_no"] for r in calls.collect()} == want
    for r in call_report(calls, ["id"]).collect():
        own = [x for x in rows if x[0] == r["key"] and want[x[2]] == r["chunk_no"]]
        bad = sorted((x[2], x[3]) for x in own if x[3])
        assert (r["n_records"], r["n_failed"]) == (len(own), len(bad))
        assert [(f["id"], f["error_code"]) for f in r["first_failures"]] == bad[:5]


def test_archive_parquet(spark, tmp_path):
    src = tmp_path / "s"
    src.mkdir()
    (src / "a.txt").write_text("x\ny\n")
    out = str(tmp_path / "pq")
    q = archive.start_archive(spark.readStream.text(str(src)), out, str(tmp_path / "ck"), fmt="parquet",
                              trigger={"availableNow": True})
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2


def _rows(seed, n=300, keys=4):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    return [(rnd.choice("abcd"[:keys]), t0 + dt.timedelta(hours=rnd.randint(0, 24 * 40)), i)
            for i in range(n)]


def test_latest_per_key_brute_force(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id long")
    got = {r["k"]: r["id"] for r in dedup.latest_per_key(df, ["k"], ["t", "id"]).collect()}
    want = {}
    for k, t, i in rows:
        if k not in want or (t, i) > want[k]:
            want[k] = (t, i)
    assert got == {k: v[1] for k, v in want.items()}


def test_first_seen_ttl_brute_force(spark):
    rows = _rows(2)
    ttl = dt.timedelta(days=7)
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id long")
    got = sorted((r["k"], r["first_seen"], r["id"]) for r in
                 dedup.first_seen_with_ttl(df, ["k"], "t", 7 * 86400, order=["t", "id"]).collect())
    want = []
    last = {}
    for k, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if k not in last or t >= last[k] + ttl:
            last[k] = t
            want.append((k, t, i))
    assert got == sorted(want)


def test_first_seen_keeps_records_without_a_time_and_cleans_up(spark):
    import os

    from tidepool.session import checkpoint_dir
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", None, 3), ("a", None, 1), ("a", t0, 2), ("a", t0 + dt.timedelta(days=9), 4), ("b", None, 5)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id long")
    out = dedup.first_seen_with_ttl(df, ["k"], "t", 7 * 86400, order=["t", "id"])
    scratch = checkpoint_dir(spark).removeprefix("file:")
    assert not [f for f in os.listdir(scratch) if f.startswith("first_seen_")]
    got = sorted(((r["k"], r["id"], r["expires_at"]) for r in out.collect()), key=str)
    at = int((t0 - dt.datetime(1970, 1, 1)).total_seconds())
    assert got == sorted([("a", 1, None), ("a", 2, at + 7 * 86400), ("a", 4, at + 16 * 86400), ("b", 5, None)],
                         key=str)


def test_asof_join_brute_force(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    left = [(rnd.choice("xy"), t0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5)), i)
            for i in range(200)]
    right = [(rnd.choice("xyz"), t0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5)), 1000 + i)
             for i in range(150)]
    L = spark.createDataFrame(left, "k string, ts timestamp_ntz, lid long")
    R = spark.createDataFrame(right, "k string, rts timestamp_ntz, rid long")
    got = {r["lid"]: r["rid"] for r in
           asof_join(L, R, ["k"], "ts", "rts", ["rid"], tiebreak=["rid"], bucket_seconds=6 * 3600)
           .collect()}
    want = {}
    for k, t, i in left:
        cands = [(rt, rid) for rk, rt, rid in right if rk == k and rt <= t]
        want[i] = max(cands)[1] if cands else None
    assert got == want


def test_next_in_sequence_brute_force(spark):
    rows = _rows(4, n=400, keys=3)
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id long")
    got = {r["id"]: r["next_ts"] for r in
           cdc.next_in_sequence(df, ["k"], "t", ["id"], bucket_seconds=3 * 86400).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        seq = sorted((t, i) for kk, t, i in rows if kk == k)
        for j, (t, i) in enumerate(seq):
            want[i] = seq[j + 1][0] if j + 1 < len(seq) else None
    assert got == want


def test_zones_and_adhoc_sql(spark, tmp_path):
    from tidepool.plans import catalog
    zones = catalog.create_zones(spark, str(tmp_path / "lake"), prefix="tp")
    assert set(zones) == {"raw", "bronze", "silver", "gold"}
    path = str(tmp_path / "t")
    spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, n int").write.partitionBy("symbol") \
        .parquet(path)
    t = catalog.register_parquet_table(spark, "tp_bronze.t", path)
    assert t.count() == 2
    assert spark.sql("SELECT sum(n) FROM tp_bronze.t WHERE symbol = 'B'").first()[0] == 2
    for z in zones.values():
        spark.sql(f"DROP DATABASE {z} CASCADE")


def test_cluster_conf_sizes_partitions():
    from tidepool.session import cluster_conf
    c = cluster_conf(shuffle_bytes=20 * (1 << 40), total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 20 * (1 << 40) // (256 << 20) + 1
    small = cluster_conf(shuffle_bytes=1 << 20, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24000
    assert c["spark.sql.adaptive.enabled"] == "true"


def test_convert_archive_to_parquet(spark, tmp_path):
    import gzip
    import json as _json
    from tidepool.streaming.archive import convert_archive
    d = tmp_path / "arch" / "year=2026" / "month=06" / "day=05" / "hour=09"
    d.mkdir(parents=True)
    with gzip.open(d / "p.gz", "wb") as f:
        f.write((_json.dumps({"dedup_key": "a"}) + _json.dumps({"dedup_key": "b"}) + "{bad").encode())
    out = str(tmp_path / "pq")
    convert_archive(spark, str(tmp_path / "arch"), out, record_start=r'(?=\{"dedup_key":|\{bad)')
    back = spark.read.parquet(out)
    assert back.count() == 3
    assert back.where("_corrupt_record IS NULL").count() == 2
    assert back.select("hour").distinct().first()[0] == 9


def test_projection_location_and_grid(spark):
    from tidepool.sources.projection import expected_partitions, location
    grid = expected_partitions(spark, ["AAPL", "MSFT"], "2026-06-05 22:00:00", "2026-06-06 01:00:00")
    assert grid.count() == 8
    row = spark.createDataFrame([("AAPL", "2026", "06", "05", "09")],
                                "symbol string, year string, month string, day string, hour string")
    assert row.select(location()).first()[0] == \
        "source=finnhub/asset_class=equity/symbol=AAPL/year=2026/month=06/day=05/hour=09/"


def test_write_bronze_registers_table(spark, tmp_path):
    from tidepool.sinks.files import write_bronze
    df = spark.createDataFrame([("A", 2026, "k1"), ("B", 2026, "k2")], "symbol string, event_year int, k string")
    path = str(tmp_path / "bronze_t")
    write_bronze(df, path, ["symbol", "event_year"], table="bronze_news_t")
    write_bronze(df.limit(1), path, ["symbol", "event_year"], table="bronze_news_t")  # update
    assert spark.table("bronze_news_t").count() == 3
    spark.sql("DROP TABLE bronze_news_t")


def test_iso_utc_and_ttl(spark):
    from tidepool.functions import timecols
    r = spark.createDataFrame([("2026-06-05 09:00:00.5",)], "t string").select(
        timecols.iso_utc(F.col("t").cast("timestamp")).alias("iso"),
        timecols.ttl_epoch(F.col("t").cast("timestamp")).alias("ttl")).first()
    assert r["iso"] == "2026-06-05T09:00:00.500000+00:00"
    assert r["ttl"] == 1780650000 + 30 * 86400


def test_first_seen_keys_against_seen_table(spark):
    seen = spark.createDataFrame([("a",)], "k string")
    df = spark.createDataFrame([("a", 1, 10), ("b", 2, 11), ("b", 1, 12), ("c", 5, 13)],
                               "k string, t int, id int")
    got = {r["k"]: r["id"] for r in dedup.first_seen_keys(df, seen, "k", "t", ["id"]).collect()}
    assert got == {"b": 12, "c": 13}


def test_checkpoint_dir_prefers_the_sessions_setting(spark, tmp_path):
    from tidepool.session import checkpoint_dir
    d = checkpoint_dir(spark)
    assert d and d == checkpoint_dir(spark)  # stable once chosen


def test_asof_join_strictly_before_brute_force(spark):
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    # coarse times so that equal left/right times occur often
    left = [(rnd.choice("xy"), t0 + dt.timedelta(hours=rnd.randint(0, 200)), i) for i in range(150)]
    right = [(rnd.choice("xy"), t0 + dt.timedelta(hours=rnd.randint(0, 200)), 1000 + i) for i in range(150)]
    L = spark.createDataFrame(left, "k string, ts timestamp_ntz, lid long")
    R = spark.createDataFrame(right, "k string, rts timestamp_ntz, rid long")
    got = {r["lid"]: r["rid"] for r in
           asof_join(L, R, ["k"], "ts", "rts", ["rid"], tiebreak=["rid"], bucket_seconds=86400,
                     allow_equal=False).collect()}
    want = {}
    for k, t, i in left:
        cands = [(rt, rid) for rk, rt, rid in right if rk == k and rt < t]
        want[i] = max(cands)[1] if cands else None
    assert got == want


def test_first_seen_ttl_with_null_keys(spark):
    rnd = random.Random(6)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice(["a", None]), t0 + dt.timedelta(hours=rnd.randint(0, 24 * 30)), i)
            for i in range(200)]
    ttl = dt.timedelta(days=5)
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id long")
    got = sorted((r["k"] or "", r["first_seen"], r["id"]) for r in
                 dedup.first_seen_with_ttl(df, ["k"], "t", 5 * 86400, order=["t", "id"]).collect())
    want, last = [], {}
    for k, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if k not in last or t >= last[k] + ttl:
            last[k] = t
            want.append((k or "", t, i))
    assert got == sorted(want)
