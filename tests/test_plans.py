"""Physical-plan properties the design relies on (checked on the executed plan)."""

import re

import pytest

from conftest import SF_ORACLE
from tidepool.operators.filters import partition_predicate
from tidepool.plans.registry import REGISTRY


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
                          plan))


def test_detector_is_one_partial_aggregate_and_one_exchange(spark):
    plan = _plan(REGISTRY["a1_anomaly_5m"].build(spark, SF_ORACLE))
    assert _exchanges(plan) == 1
    assert len(re.findall(r"HashAggregate", plan)) >= 2  # partial + final
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_in_registered_plans(spark, name):
    plan = _plan(REGISTRY[name].build(spark, SF_ORACLE))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert not re.search(r"(MapIn|GroupsIn|CoGroupsIn)(Pandas|Arrow)|(MapInArrow|PythonMapInArrow)", plan)


def test_filters_reach_the_scan(spark):
    plan = _plan(REGISTRY["f2_trade_filter"].build(spark, SF_ORACLE))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan
    plan = _plan(REGISTRY["f5_date_range"].build(spark, SF_ORACLE))
    assert "GreaterThanOrEqual(ts," in plan


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    for name in ("d3_latest_per_key", "p1_bronze_news", "x14_cdc_current_state", "x8_latest_quote"):
        plan = _plan(REGISTRY[name].build(spark, SF_ORACLE))
        assert "Window" not in plan, name
        assert "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan


def test_rollup_preaggregates_before_the_join(spark):
    plan = REGISTRY["x13_sector_rollup"].build(spark, SF_ORACLE)._jdf.queryExecution() \
        .optimizedPlan().toString()
    # the lineitem aggregate sits below the join with the supplier dimension
    join_at = plan.find("Join")
    assert plan.find("Aggregate [l_suppkey") > join_at >= 0


def test_partition_filters_prune_directories(spark, tmp_path):
    df = spark.createDataFrame([("A", 2026, 1), ("B", 2026, 2)], "symbol string, year int, v int")
    path = str(tmp_path / "p")
    df.write.partitionBy("symbol", "year").parquet(path)
    plan = _plan(spark.read.parquet(path).where(partition_predicate(["A"], year=2026)))
    assert re.search(r"PartitionFilters: \[[^\]]*symbol", plan)


# These settle an order of events or rewrite a table: their work is rounds of jobs.
EAGER = {"d4_first_seen_ttl", "a2_alert_batches", "x19_merge"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - EAGER))
def test_building_a_query_runs_no_job(spark, name):
    """Nothing but reading the tables' footers, which ``read.parquet`` does."""
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", name)
    try:
        REGISTRY[name].build(spark, SF_ORACLE)
        tracker = sc.statusTracker()
        stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup(f"build-{name}")
                  for i in tracker.getJobInfo(j).stageIds]
        assert all(s is None or s.name.startswith("parquet at") for s in stages)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_features_join_is_not_forced_and_ticks_meet_no_window(spark):
    df = REGISTRY["x18_feature_table"].build(spark, SF_ORACLE)
    assert "strategy=" not in df._jdf.queryExecution().optimizedPlan().toString()
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    # Spark broadcasts the bars here; windows and their sorts are on that side only
    at = final.find("BroadcastHashJoin")
    ticks = final[at:final.find("BroadcastQueryStage")]
    assert at > 0 and "Window [" not in final[:at] and "Window [" not in ticks and "Sort [" not in ticks


def test_foreign_keys_are_counted_before_they_are_shuffled(spark):
    plan = REGISTRY["x11_quality_rules"].build(spark, SF_ORACLE)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[l_partkey#\d+L?\]", plan) or "Aggregate [__k" in plan


def test_projection_filter_reaches_the_scan(spark):
    plan = _plan(REGISTRY["f7_projection_domain"].build(spark, SF_ORACLE))
    assert "In(event_type" in plan and "GreaterThanOrEqual(ts," in plan and "array_contains" not in plan


def test_publish_numbers_calls_without_a_window_over_a_key(spark):
    plan = REGISTRY["k4_publish_chunks"].build(spark, SF_ORACLE)._jdf.queryExecution().optimizedPlan().toString()
    numbering = [x for x in plan.split("\n") if "row_number()" in x]
    assert numbering and all("__slot" in x for x in numbering)
