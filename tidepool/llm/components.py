"""Connected components of an edge table, by star contraction.

Edges are first contracted inside each task (a forest over the task's own
nodes), then large-star and small-star steps alternate until every node hangs
on the smallest node of its component.  Each round is written to the shared
checkpoint folder; nothing but two numbers a round reaches the driver.  Joins
are on node ids with ordinary shuffle joins, so a node with very many edges
is split by adaptive execution.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import anchored

EDGE = "a bigint, b bigint"


def _contract(batches):
    """Edges of a task -> (node, smallest node it is joined with here)."""
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            rx, ry = find(x), find(y)
            parent.setdefault(rx, rx)
            parent.setdefault(ry, ry)
            parent.setdefault(x, rx)
            parent.setdefault(y, ry)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
    pairs = np.array([(x, r) for x in parent if (r := find(x)) != x], dtype=np.int64).reshape(-1, 2)
    for at in range(0, len(pairs), 100_000):
        part = pairs[at:at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], ["a", "b"])


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = (down.join(least, "a").where("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a non-loop edge; component is the
    smallest node reachable.  Null ends and loops are ignored, repeated edges
    count once, no edges give no rows."""
    e = (edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b"))
         .where("a is not null and b is not null and a <> b"))
    e = anchored(e.mapInArrow(_contract, EDGE))
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = now
        e = anchored(_small_star(_large_star(e)))
