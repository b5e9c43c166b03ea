"""Operator 12 against comparing every anchor with every row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import gnat
from tidepool.llm.common import ship_package

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, every, scale=256.0, positives=5, negatives=3):
    own = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        own[i, label, tuple(math.floor(scale * x) for x in e)] = None
    own = list(own)

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2], strict=False))  # as if zeros followed

    out = []
    for a in (r for r in own if r[0] % every == 0):
        scored = sorted(((-score(a, b), b[0], b[1]) for b in own if b != a))
        for p, i, _ in [x for x in scored if x[2] == a[1]][:positives]:
            fits = [x for x in scored if x[2] != a[1] and -50 * p <= -100 * x[0] <= -95 * p][:negatives]
            out += [(a[0], i, r, n, -p, -s) for r, (s, n, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, every, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    r = gnat.mine(df, F.col("vec_id") % every == 0, label=F.col("label"), **kw)
    assert r.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(x) for x in r.collect())


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def clustered(rng, n, dim, labels):
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.6], (n, 1))
    return [(int(i), [float(v) for v in e], int(rng.integers(0, labels))) for i, e in enumerate(x)]


def test_equals_plain_search_with_copies_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = clustered(rng, 2600, 6, 3)
    rows += [(5000 + i, rows[7][1], i % 3) for i in range(900)]  # a third: copies, all tied
    rows += [(9000 + i, [float(v) for v in rng.integers(-1, 2, 6)], i % 2) for i in range(300)]  # ties all over
    assert mined(spark, rows, 61) == plain(rows, 61)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    rows = clustered(rng, 60, 4, 2)
    rows += [(100, None, 1), (110, [1.0, None], 1), (120, [nan, 1.0], 0), (130, [inf], 0), (140, [1.0, 2.0], None),
             (None, [1.0, 1.0, 1.0, 1.0], 1), (150, [], 1), (160, [0.0] * 4, 0), (170, [3.0], 1),
             (180, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 0), (0, [9.0, 9.0], 1), (0, [9.0, 9.0], 1), (0, [8.0, 9.0], 1),
             (-10, [-2.0, 1.0], 0)]
    assert mined(spark, rows, 10) == plain(rows, 10)
    huge = [(i, [x * 1000 for x in e], label) for i, e, label in clustered(rng, 40, 4, 2)]
    assert mined(spark, huge, 10) == plain(huge, 10)
    assert mined(spark, huge + [(200, [1e30], 1)], 10) == plain(huge, 10)  # no score in 64 bits: no part


def test_empty_tables_and_clashing_columns(spark):
    rows = clustered(np.random.default_rng(3), 50, 3, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    assert gnat.mine(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert gnat.mine(df, F.col("vec_id") < 0).count() == 0
    more = df.selectExpr("*", "1 as leaf", "2 as v", "3 as rank", "4 as anchor", "5 as x")
    got = gnat.mine(more, F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 5)


def test_siblings_out_of_reach_are_never_compared(spark):
    """Ranges leave out leaves, and never one that holds a row of the window."""
    rng = np.random.default_rng(4)
    x = np.array([e for _, e, _ in clustered(rng, 4000, 5, 2)]) * 100
    tree = gnat.Tree(np.round(x[:800]).astype(np.int64), 200.0)  # many small leaves
    ranges = gnat.Ranges(tree)
    x = np.round(x)
    leaf = ranges.add(tree, x)
    q = x[::40]
    scores = q @ x.T
    low = np.partition(scores, -20, axis=1)[:, -20]
    query, to = ranges.reached(tree, q, low, scores.max(1))
    reached = set(zip(query.tolist(), to.tolist(), strict=True))
    for i, j in zip(*np.nonzero(scores >= low[:, None]), strict=True):
        assert (int(i), int(leaf[j])) in reached
    assert len(reached) < 0.6 * len(q) * len(tree.leaf_point)
