"""Hard negatives by a GNAT-style multiway hyperplane tree.

A node of the tree has up to ``FANOUT`` split points; a row belongs to the
nearest one (the hyperplanes between split points part the space).  For each
split point i and sibling subtree j the node keeps the least and largest
distance from i to any row of j, and each subtree its range of norms.  The split
points are fitted on a bounded sample; the ranges come from all rows, and every
row is indexed.

A search asks for rows whose inner product with a query lies in a window.  With
the norms of a subtree the window is an annulus of distances around the query,
and by the triangle inequality subtree j is out as soon as, for any split point
i, its distance range misses the annulus moved by the query's own distance to i.
What is left are leaves, and there every row is compared exactly.  The k best are
wanted, so each search first visits the leaves next to the query; the k-th best
score found there raises the window's lower end, and the annulus shrinks for the
visit of all leaves left.

Two searches make the job: the positives (same label, window open), then the
negatives (other labels, a window for each positive).

Leaves are cut into blocks of about ``BLOCK`` rows and queries into groups of
about ``GROUP``; a (leaf, block, group) is one unit of work, and a group takes
part only in leaves that one of its queries can reach.  So a leaf or a place with
a third of all rows is many units.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import anchored

FANOUT = 8
SAMPLE = 8192        # rows on which split points are fitted
LEAF_ROWS = 1024     # a subtree with more rows (by its share of the sample) is split again
LEAST_SAMPLE = 32    # ... if it holds so many rows of the sample
BLOCK = 4096         # rows of a leaf in one unit
GROUP = 512          # queries in one unit
NEAR = 2             # leaves visited first
LARGEST = 2.0 ** 55  # of squared norms: scores and their hundredfold stay in 64 bits
LOWEST = -(1 << 62)


# ------------------------------------------------------------------ tree
class Tree:
    """``nodes``: (split points, children); a child is a node's number, or -1 - leaf."""

    def __init__(self, sample: np.ndarray, rows_each: float):
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.leaf_point: list[np.ndarray] = []
        self._grow(sample.astype(np.float64), rows_each, None)

    def _grow(self, x: np.ndarray, rows_each: float, point) -> int:
        small = len(x) * rows_each <= LEAF_ROWS or len(x) < LEAST_SAMPLE
        splits = _far_apart(x) if not small else x[:0]
        if self.nodes and len(splits) < 2:
            self.leaf_point.append(point)
            return -len(self.leaf_point)
        if not len(splits):
            splits = x[:1]
        at, children = len(self.nodes), []
        self.nodes.append((splits, children))
        near = _squares(x, splits).argmin(axis=1)
        for j in range(len(splits)):
            children.append(self._grow(x[near == j], rows_each, splits[j]))
        return at

    def descend(self, x: np.ndarray, visit=None) -> np.ndarray:
        """The leaf of each row; ``visit(node, rows, distances, chosen)`` sees every step."""
        leaf = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            splits, children = self.nodes[node]
            d = _squares(x[rows], splits)
            near = d.argmin(axis=1)
            if visit:
                visit(node, rows, d, near)
            for j, child in enumerate(children):
                own = rows[near == j]
                if child < 0:
                    leaf[own] = -1 - child
                elif len(own):
                    todo.append((child, own))
        return leaf


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, never below zero."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T), 0)


def _far_apart(x: np.ndarray) -> np.ndarray:
    """Up to FANOUT different rows, each the farthest from those before, of the first few."""
    few = np.unique(x[:4 * FANOUT], axis=0)
    chosen = [0]
    d = _squares(few, few[:1])[:, 0]
    while len(chosen) < min(FANOUT, len(few)):
        at = int(d.argmax())
        if at in chosen:
            break
        chosen.append(at)
        d = np.minimum(d, _squares(few, few[at:at + 1])[:, 0])
    return few[chosen]


class Ranges:
    """Distance ranges (node, split point, subtree) and squared norms (node, subtree)."""

    def __init__(self, tree: Tree):
        self.lo = [np.full((len(s), len(s)), np.inf) for s, _ in tree.nodes]
        self.hi = [np.full((len(s), len(s)), -np.inf) for s, _ in tree.nodes]
        self.norm_lo = [np.full(len(s), np.inf) for s, _ in tree.nodes]
        self.norm_hi = [np.full(len(s), -np.inf) for s, _ in tree.nodes]

    def add(self, tree: Tree, x: np.ndarray) -> np.ndarray:
        norms = (x * x).sum(1)

        def visit(node, rows, d, near):
            d = np.sqrt(d)
            for j in np.unique(near):
                own, n = d[near == j], norms[rows[near == j]]
                self.lo[node][:, j] = np.minimum(self.lo[node][:, j], own.min(0))
                self.hi[node][:, j] = np.maximum(self.hi[node][:, j], own.max(0))
                self.norm_lo[node][j] = min(self.norm_lo[node][j], n.min())
                self.norm_hi[node][j] = max(self.norm_hi[node][j], n.max())

        return tree.descend(x, visit)

    def reached(self, tree: Tree, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) pairs whose annuli meet: scores in [low, high] may lie there."""
        norm = (x * x).sum(1)
        found, todo = [], [(0, np.flatnonzero(low <= high))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            splits, children = tree.nodes[node]
            # rounding of squared distances, as a distance
            most = norm[rows] + max(0, self.norm_hi[node].max()) + (splits * splits).sum(1).max()
            slack = 4 * np.sqrt(1e-12 * most)[:, None]
            own = np.sqrt(_squares(x[rows], splits))
            with np.errstate(invalid="ignore"):
                near2 = norm[rows, None] + self.norm_lo[node][None, :] - 2 * high[rows, None]
                far2 = norm[rows, None] + self.norm_hi[node][None, :] - 2 * low[rows, None]
            live = (far2 >= -slack ** 2) & np.isfinite(self.norm_lo[node])[None, :]
            near = np.sqrt(np.maximum(near2, 0)) - slack
            far = np.sqrt(np.maximum(far2, 0)) + slack
            for i in range(len(splits)):
                q = own[:, i:i + 1]
                live &= (self.lo[node][i][None, :] <= q + far) & (
                    self.hi[node][i][None, :] >= np.maximum(near - q, q - far))
            for j, child in enumerate(children):
                go = rows[live[:, j]]
                if child < 0:
                    found.append((go, np.full(len(go), -1 - child)))
                else:
                    todo.append((child, go))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


# ------------------------------------------------------------------ index
ROW = "leaf bigint, vec_id bigint, row_key binary, label bigint, anchor boolean, v binary"


def _vectors(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


def _indexed(tree, dim: int):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("v")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            x = np.zeros((b.num_rows, dim), np.int64)
            x[np.arange(dim)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            leaf = tree.value.descend(x.astype(np.float64))
            packed = [r.tobytes() for r in x]
            keys = [hashlib.md5(p + str(n).encode()).digest()
                    for p, n in zip(packed, b.column("label").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.int64()), b.column("vec_id"), pa.array(keys, pa.binary()), b.column("label"),
                 b.column("anchor"), pa.array(packed, pa.binary())],
                ["leaf", "vec_id", "row_key", "label", "anchor", "v"])
    return run


def _ranged(tree, dim: int):
    """Index rows -> a task's ranges: (node, i, j, lo, hi), norms under i = -1."""
    def run(batches):
        t = tree.value
        r = Ranges(t)
        for b in batches:
            if b.num_rows:
                r.add(t, _vectors(b.column("v"), dim).astype(np.float64))
        out = []
        for node in range(len(t.nodes)):
            for j in np.flatnonzero(np.isfinite(r.norm_lo[node])).tolist():
                out.append((node, -1, j, float(r.norm_lo[node][j]), float(r.norm_hi[node][j])))
                out += [(node, i, j, float(r.lo[node][i, j]), float(r.hi[node][i, j])) for i in range(len(r.lo[node]))]
        kinds = [pa.int64()] * 3 + [pa.float64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out, strict=True)) or [()] * 5,
                                                                         kinds, strict=True)],
                                         ["node", "i", "j", "lo", "hi"])
    return run


class Index:
    """All rows under the leaves of a tree, and the tree's ranges."""

    def __init__(self, rows: DataFrame):
        """``rows``: vec_id bigint, label bigint, anchor boolean, v array<bigint>, no nulls."""
        spark = rows.sparkSession
        rows = rows.dropDuplicates(["vec_id", "label", "v"])
        n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
        self.dim = max(1, dim or 0)
        drawn = rows.select("v").orderBy(F.xxhash64("vec_id", "v"), "v").limit(SAMPLE).collect()
        sample = np.zeros((max(1, len(drawn)), self.dim), np.int64)
        for i, r in enumerate(drawn):
            sample[i, :len(r["v"])] = r["v"]
        tree = Tree(sample, (n or 0) / max(1, len(drawn)))
        self.tree = spark.sparkContext.broadcast(tree)
        self.rows = anchored(rows.mapInArrow(_indexed(self.tree, self.dim), ROW))
        ranges = Ranges(tree)
        # sums over all rows: at most FANOUT squared rows a node, and a row a leaf
        for node, i, j, lo, hi in (self.rows.mapInArrow(_ranged(self.tree, self.dim),
                                                        "node bigint, i bigint, j bigint, lo double, hi double")
                                   .groupBy("node", "i", "j").agg(F.min("lo"), F.max("hi")).collect()):
            if i < 0:
                ranges.norm_lo[node][j], ranges.norm_hi[node][j] = lo, hi
            else:
                ranges.lo[node][i, j], ranges.hi[node][i, j] = lo, hi
        self.ranges = spark.sparkContext.broadcast(ranges)
        size, asked = {}, {}
        for leaf, count, anchors in self.rows.groupBy("leaf").agg(F.count("*"), F.count_if("anchor")).collect():
            size[leaf], asked[leaf] = count, anchors
        self.blocks = {leaf: -(-c // BLOCK) for leaf, c in size.items()}
        # neighbouring leaves share query groups; a leaf with many queries has several
        self.groups, at, filled = {}, 0, 0
        for leaf in sorted(asked):
            if filled and filled + asked[leaf] > GROUP:
                at, filled = at + 1, 0
            parts = max(1, -(-asked[leaf] // GROUP))
            self.groups[leaf] = (at, parts)
            at, filled = (at + parts, 0) if parts > 1 else (at, filled + asked[leaf])

    def _by_leaf(self, of: dict, default):
        pairs = [F.lit(x) for kv in sorted(of.items()) for x in kv]
        return F.coalesce(F.create_map(*pairs)[F.col("leaf")], F.lit(default)) if pairs else F.lit(default)

    def queries(self) -> DataFrame:
        """The anchors, each with its group."""
        first = self._by_leaf({k: v[0] for k, v in self.groups.items()}, 0)
        parts = self._by_leaf({k: v[1] for k, v in self.groups.items()}, 1)
        return self.rows.where("anchor").select(
            "vec_id", "row_key", "label", "v",
            (first + F.pmod(F.xxhash64("vec_id", "row_key"), parts)).cast("bigint").alias("grp"))

    # -------------------------------------------------------------- search
    def best(self, queries: DataFrame, k: int, same_label: bool) -> DataFrame:
        """The k best rows of each window of each query: vec_id, row_key, place
        (of the window, from 0), rank (int, from 1), id, score; higher scores
        first, equal ones by smaller id.  ``queries`` has ``low`` and ``high``,
        arrays of the windows' ends (both inclusive)."""
        first = self._visited(queries, k, same_label, near_only=True)
        raised = (first.where(F.col("rank") == k).groupBy("vec_id", "row_key")
                  .agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("found")))
        again = queries.join(raised, ["vec_id", "row_key"], "left").withColumn(
            "low", F.transform("low", lambda lo, i: F.greatest(lo, F.coalesce(F.col("found")[i], lo)))).drop("found")
        return self._visited(again, k, same_label, near_only=False)

    def _visited(self, queries: DataFrame, k: int, same_label: bool, near_only: bool) -> DataFrame:
        asked = queries.mapInArrow(
            _reaching(self.tree, self.ranges, self.dim, near_only),
            "leaf bigint, grp bigint, vec_id bigint, row_key binary, label bigint, v binary, "
            "low array<bigint>, high array<bigint>")
        blocks = self._by_leaf(self.blocks, 1)
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        units = asked.select("leaf", F.col("grp").alias("for_grp")).distinct()
        rows = (self.rows.select("leaf", "vec_id", "row_key", "label", "v",
                                 F.pmod(F.xxhash64("vec_id", "row_key"), blocks).cast("int").alias("block"))
                .join(units, "leaf"))
        found = rows.groupBy("leaf", "block", "for_grp").cogroup(asked.groupBy("leaf", "block", "grp")).applyInArrow(
            _compared(self.dim, k, same_label), "vec_id bigint, row_key binary, place int, id bigint, score bigint")
        order = Window.partitionBy("vec_id", "row_key", "place").orderBy(F.col("score").desc(), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _reaching(tree, ranges, dim: int, near_only: bool):
    """Queries -> a row for each leaf they have to visit."""
    def run(batches):
        t, r = tree.value, ranges.value
        points = np.array([p for p in t.leaf_point]).reshape(-1, dim)
        for b in batches:
            if not b.num_rows:
                continue
            x = _vectors(b.column("v"), dim).astype(np.float64)
            # one annulus a query: from its lowest window's begin to its highest one's end
            ends = [(min((lo for lo, hi in zip(ls, hs, strict=True) if lo <= hi), default=1),
                     max((hi for lo, hi in zip(ls, hs, strict=True) if lo <= hi), default=0))
                    for ls, hs in zip(b.column("low").to_pylist(), b.column("high").to_pylist(), strict=True)]
            low, high = np.array(ends, np.float64).reshape(-1, 2).T
            if near_only:
                some = np.flatnonzero(low <= high)
                near = np.argsort(_squares(x[some], points), axis=1, kind="stable")[:, :NEAR]
                query, leaf = np.repeat(some, near.shape[1]), near.reshape(-1)
            else:
                query, leaf = r.reached(t, x, low, high)
            for at in range(0, len(query), 20_000):
                part = b.take(pa.array(query[at:at + 20_000]))
                names = ["grp", "vec_id", "row_key", "label", "v", "low", "high"]
                yield pa.RecordBatch.from_arrays([pa.array(leaf[at:at + 20_000], pa.int64()),
                                                  *[part.column(n) for n in names]], ["leaf", *names])
    return run


def _compared(dim: int, k: int, same_label: bool):
    """One unit: a block's rows and the queries that visit it -> the unit's k best of each window."""
    kinds = pa.schema([("vec_id", pa.int64()), ("row_key", pa.binary()), ("place", pa.int32()), ("id", pa.int64()),
                       ("score", pa.int64())])

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return kinds.empty_table()
        rows = rows.sort_by([("vec_id", "ascending"), ("row_key", "ascending")])
        x, q = _vectors(rows.column("v"), dim), _vectors(asked.column("v"), dim)
        if float(np.abs(x).max()) * float(np.abs(q).max()) * dim < 1 << 52:
            s = (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        else:
            s = q @ x.T
        ids = rows.column("vec_id").to_numpy()
        label, mine = rows.column("label").to_numpy(), asked.column("label").to_numpy()
        fits = (mine[:, None] == label[None, :]) if same_label else (mine[:, None] != label[None, :])
        if same_label:  # not the query itself
            where = {key: i for i, key in enumerate(zip(ids.tolist(), rows.column("row_key").to_pylist(), strict=True))}
            for i, key in enumerate(zip(asked.column("vec_id").to_pylist(), asked.column("row_key").to_pylist(),
                                        strict=True)):
                if key in where:
                    fits[i, where[key]] = False
        lows, highs = asked.column("low").to_pylist(), asked.column("high").to_pylist()
        out = []
        for place in range(max(map(len, lows))):
            lo = np.array([v[place] if place < len(v) else 1 for v in lows], np.int64)[:, None]
            hi = np.array([v[place] if place < len(v) else 0 for v in highs], np.int64)[:, None]
            own = np.where(fits & (s >= lo) & (s <= hi), s, LOWEST)
            least = np.partition(own, -k, axis=1)[:, -k][:, None] if own.shape[1] > k else LOWEST
            at, to = np.nonzero((own >= least) & (own > LOWEST))
            score = own[at, to]
            order = np.lexsort((to, -score, at))  # rows stand by id
            at, to, score = at[order], to[order], score[order]
            begin = np.searchsorted(at, at)
            keep = np.arange(len(at)) - begin < k
            out.append(pa.table([asked.column("vec_id").take(pa.array(at[keep])),
                                 asked.column("row_key").take(pa.array(at[keep])),
                                 pa.array(np.full(int(keep.sum()), place), pa.int32()),
                                 pa.array(ids[to[keep]], pa.int64()), pa.array(score[keep], pa.int64())],
                                schema=kinds))
        return pa.concat_tables(out)
    return run


# ------------------------------------------------------------------ mining
def _floor_div(a, b: int):
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def usable(rows: DataFrame, scale: float) -> DataFrame:
    """vec_id, label, anchor, v of the rows that take part."""
    x = F.col("x")
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    v = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e))
    norm = F.aggregate(x, F.lit(0.0), lambda a, e: a + F.pow(F.lit(float(scale)) * e, F.lit(2)))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull())
            .where(F.coalesce(whole, F.lit(False)) & (norm < LARGEST))
            .select("vec_id", "label", F.coalesce("anchor", F.lit(False)).alias("anchor"), v.alias("v")))


def mine(vectors: DataFrame, anchor, *, id_col: str = "vec_id", vector_col: str = "embedding",
         label=None, scale: float = 256.0, positives: int = 5, negatives: int = 3, low_percent: int = 50,
         high_percent: int = 95) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank (int, from 1), negative_id,
    positive_score, negative_score (bigint).

    Components x count as floor(``scale`` * x); a score is the inner product of
    these integers, shorter vectors counting as if zeros followed.  ``anchor``
    (a condition on a row) names the anchors, ``label`` (a column or expression,
    integer) the classes.  An anchor's positives are the ``positives`` best other
    rows of its label; a positive's negatives the ``negatives`` best rows of other
    labels whose score s satisfies low_percent * p <= 100 * s <= high_percent * p.
    Higher scores come first, equal ones by smaller id.  Fewer rows give fewer
    results, an anchor without positives or a positive without negatives none.

    Rows with a null id, label or vector, or with null or non-finite components,
    take no part, nor do vectors of a squared length of 2^55 or more (after
    scaling), whose scores exceed 64 bits.  Rows equal in id, label and vector
    count once; rows that share an id only are rows of their own.  An empty table
    gives no rows.  Other columns are not read and can't clash.
    """
    own = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
                         (F.col("`label`") if label is None else label).cast("bigint").alias("label"),
                         anchor.alias("anchor"), F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    index = Index(usable(own, scale))
    anchors = index.queries()
    open_ = anchors.withColumns({"low": F.array(F.lit(LOWEST + 1)), "high": F.array(F.lit(-LOWEST))})
    best = anchored(index.best(open_, positives, same_label=True)
                    .select("vec_id", "row_key", "rank", F.col("id").alias("positive_id"),
                            F.col("score").alias("positive_score")))
    p = F.col("positive_score")
    windows = best.withColumns({"lo": -_floor_div(-low_percent * p, 100), "hi": _floor_div(high_percent * p, 100)})
    listed = (windows.groupBy("vec_id", "row_key")
              .agg(F.array_sort(F.collect_list(F.struct("rank", "lo", "hi"))).alias("w"))
              .select("vec_id", "row_key", F.col("w.lo").alias("low"), F.col("w.hi").alias("high")))
    found = index.best(anchors.join(listed, ["vec_id", "row_key"]), negatives, same_label=False)
    named = found.select("vec_id", "row_key", (F.col("place") + 1).alias("of"), "rank",
                         F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (named.join(best.withColumnRenamed("rank", "of"), ["vec_id", "row_key", "of"])
            .select(F.col("vec_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
                    "negative_id", "positive_score", "negative_score"))
