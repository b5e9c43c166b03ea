"""Every registered query agrees with its DuckDB oracle on the driver tables."""

import pytest

from conftest import SF_ORACLE
from oracle import compare, duck

import __spark_entry__ as entry_mod
from tidepool.plans.registry import REGISTRY

SQL_QUERIES = sorted(n for n, q in REGISTRY.items() if q.sql)


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, REGISTRY[name], SF_ORACLE)
    assert res["match"], res


def test_contract_keys_line_up():
    q = entry_mod.queries()
    o = entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 20


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["symbol", "window_start", "window_end", "event_count"]
    assert len(rows) == 11


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_schema_is_stable_across_scales(spark, name):
    from conftest import SF_SMALL
    a = REGISTRY[name].build(spark, SF_SMALL).schema
    b = REGISTRY[name].build(spark, SF_ORACLE).schema
    assert [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]
