"""Hot keys cut by density; versions with null keys and deletes; merges of odd folders."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import cdc
from tidepool.operators.joins import asof_join
from tidepool.operators.slots import dense_cuts, with_slots
from tidepool.sinks.publish import publish_calls

T0 = dt.datetime(2026, 3, 1)


def hot_rows(n=30_000, seed=3):
    """A third of all rows: one key within one hour, most of them in ten minutes."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            at = T0 + dt.timedelta(hours=5, seconds=rng.choice([rng.random() * 600, rng.random() * 3600]))
            rows.append((i, "HOT", at))
        else:
            rows.append((i, rng.choice([f"k{j}" for j in range(40)] + [None]),
                         T0 + dt.timedelta(seconds=rng.random() * 4 * 86400)))
    return rows


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), "id bigint, k string, t timestamp").repartition(6).cache()


def test_a_hot_hour_is_cut_into_slots_of_the_wanted_size(spark, hot):
    cuts = dense_cuts(hot, ["k"], "t", 3600, 500)
    assert {r.k for r in cuts.select("k").collect()} == {"HOT"}  # sparse buckets meet no sketch
    sizes = sorted(r["count"] for r in with_slots(hot, cuts, ["k"], "t", 3600).where("k = 'HOT'")
                   .groupBy("__b", "__slot").count().collect())
    assert sum(sizes) == 10_000 and len(sizes) == 20
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2] and sizes[-1] <= 2 * 500
    # slots stand in the order of time
    spans = (with_slots(hot, cuts, ["k"], "t", 3600).where("k = 'HOT'").groupBy("__b", "__slot")
             .agg(F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("__b", "__slot").collect())
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:], strict=False))


def test_no_task_of_the_windows_gets_a_hot_key_whole(spark, hot):
    """Rows per shuffle partition of the window's exchange: none above twice the median."""
    cuts = dense_cuts(hot, ["k"], "t", 86400, 400)
    dealt = (with_slots(hot, cuts, ["k"], "t", 86400).repartition(12, "k", "__b", "__slot")
             .groupBy(F.spark_partition_id().alias("p")).count().collect())
    sizes = sorted(r["count"] for r in dealt)
    assert len(sizes) == 12 and sizes[-1] <= 2 * sizes[6]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_next_in_sequence_over_cut_slots_equals_brute_force(spark, hot, kind):
    df = hot.withColumn("t", F.date_trunc("second", "t").cast(kind))  # ties
    got = {r["id"]: r["next_ts"] for r in
           cdc.next_in_sequence(df, ["k"], "t", ["id"], bucket_seconds=86400, slot_rows=300).collect()}
    rows, want = {}, {}
    for r in df.collect():
        rows.setdefault(r.k, []).append((r.t, r.id))
    for own in rows.values():
        own.sort()
        for (_, i), nxt in zip(own, [*own[1:], (None, None)], strict=True):
            want[i] = nxt[0]
    assert got == want


def test_asof_join_over_cut_slots_equals_brute_force(spark, hot):
    left, right = hot.where("id % 2 = 0"), hot.where("id % 2 = 1").selectExpr("id as rid", "k", "t as rt")
    got = {r.id: r.rid for r in asof_join(left, right, ["k"], "t", "rt", ["rid"], ["rid"], slot_rows=200).collect()}
    rows, want = {}, {}
    for r in right.collect():
        rows.setdefault(r.k, []).append((r.rt, r.rid))
    import bisect
    for own in rows.values():
        own.sort()
    for r in left.collect():
        own = rows.get(r.k, []) if r.k is not None else []
        at = bisect.bisect_right(own, (r.t, 1 << 60))
        want[r.id] = own[at - 1][1] if at else None
    assert got == want


def test_publish_calls_over_cut_slots_equal_brute_force(spark, hot):
    keyed = hot.withColumnRenamed("k", "key")
    got = {r.id: r.chunk_no for r in publish_calls(keyed, "t", ["id"], chunk=37, slot_rows=150).collect()}
    rows = {}
    for r in keyed.collect():
        rows.setdefault(r.key, []).append((r.t, r.id))
    assert got == {i: n // 37 for own in rows.values() for n, (_, i) in enumerate(sorted(own))}


def test_a_null_key_has_one_current_version_and_a_delete_closes_its_interval(spark):
    day = [T0 + dt.timedelta(days=i) for i in range(6)]
    rows = [(None, 1, day[0], False), (None, 2, day[3], False), ("a", 3, day[0], False), ("a", 4, day[1], True),
            ("a", 5, day[4], False), ("b", 6, day[2], False), ("b", 7, day[5], True)]
    df = spark.createDataFrame(rows, "k string, v int, t timestamp, gone boolean")
    got = {r.v: (r.valid_from, r.valid_to, r.is_current)
           for r in cdc.scd2_intervals(df, ["k"], "t", ["v"], delete_flag="gone").collect()}
    assert got == {1: (day[0], day[3], False), 2: (day[3], None, True), 3: (day[0], day[1], False),
                   5: (day[4], None, True), 6: (day[2], day[5], False)}


@pytest.mark.parametrize("part", ["x y", "50%", "a+b", "c:d/e", "ü=1", "x%20y"])
def test_merge_removes_the_old_row_whatever_the_folder_is_called(spark, tmp_path, part):
    path, kind = str(tmp_path / "t"), "id int, part string, seq int"
    cdc.merge_partitions(spark, path, spark.createDataFrame([(1, part, 1), (2, "q", 1)], kind), ["id"], ["seq"], ["part"])
    before = set(os.listdir(path))
    cdc.merge_partitions(spark, path, spark.createDataFrame([(1, "z", 2)], kind), ["id"], ["seq"], ["part"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "part", "seq").collect()) == [
        (1, "z", 2), (2, "q", 1)]
    assert len(set(os.listdir(path)) - before - {"part=z"}) == 0


def test_merge_lost_between_write_and_removal_is_mended_by_running_it_again(spark, tmp_path, monkeypatch):
    from tidepool import session
    path, kind = str(tmp_path / "t"), "id int, part string, seq int"
    upd = spark.createDataFrame([(1, "z", 2)], kind)
    cdc.merge_partitions(spark, path, spark.createDataFrame([(1, "x y", 1)], kind), ["id"], ["seq"], ["part"])

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(session, "remove_uri", lost)
        with pytest.raises(RuntimeError):
            cdc.merge_partitions(spark, path, upd, ["id"], ["seq"], ["part"])
    assert spark.read.parquet(path).count() == 2  # the moved key stands twice
    cdc.merge_partitions(spark, path, upd, ["id"], ["seq"], ["part"])
    assert [tuple(r) for r in spark.read.parquet(path).select("id", "part", "seq").collect()] == [(1, "z", 2)]
