"""Embedding near-duplicates by lattice hashing (E8) and exact verification.

Unit vectors are projected by random Gaussian matrices to ``blocks`` times
eight dimensions, and each eight are decoded to their nearest E8 point; the
points of a table's blocks together are the vector's cell there.  In each of
``tables`` tables a vector stands in its home cell and asks in its home cell
and in the neighbouring cells (up to ``probes`` per block, in all
combinations).  Two vectors are candidates when one asks where the other
stands and their 128-bit sign sketches differ in at most ``max_bits`` places;
candidates are verified by cosine in double precision.

Equal vectors are one class and are never paired; only links between
different vectors are.  Cells are joined by an ordinary shuffle join, so a
crowded cell is split by adaptive execution; nothing is capped.

With the default parameters two random 64-dimensional vectors at a cosine of
exactly 0.95 meet with a probability above 0.999 (more above it), and a pair of
unrelated vectors meets in a table with a probability of about 1 / 33,000.
For many more vectors raise ``scale`` (smaller cells) and ``tables`` together.

Vectors that are null, zero, empty, or hold null or non-finite components, and
vectors of different lengths, are linked with nothing.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import e8
from .common import anchored, mix64, pick
from .components import connected_components

MIN_COSINE = 0.95
TABLES, BLOCKS, PROBES, SCALE = 10, 2, 3, 0.6
MAX_BITS = 34
SEED = 20240607


def _matrix(seed: int, dim: int, table: int, block: int, scale: float) -> np.ndarray:
    return np.random.default_rng((seed, dim, table, block)).normal(size=(dim, 8)) * scale


def _by_length(vectors: list) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        out.setdefault(len(v), []).append(i)
    return out


def _places(tables: int, blocks: int, probes: int, scale: float, seed: int):
    """(cell, rep, home, s1, s2): where each vector stands and asks."""
    def run(batches):
        for b in batches:
            reps = np.array(b.column("rep").to_pylist(), np.int64)
            vectors = b.column("vec").to_pylist()
            for dim, rows in _by_length(vectors).items():
                x = np.array([vectors[i] for i in rows], np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                planes = np.random.default_rng((seed, dim)).normal(size=(dim, 128))
                sketch = np.packbits(x @ planes > 0, axis=1).view(np.int64)
                for t in range(tables):
                    at = [e8.numbers(e8.cells(x @ _matrix(seed, dim, t, k, scale), probes),
                                     (dim * tables + t) * blocks + k) for k in range(blocks)]
                    for way in product(range(1 + probes), repeat=blocks):
                        cell = np.zeros(len(rows), np.uint64)
                        for k, w in enumerate(way):
                            cell = mix64(cell * np.uint64(3) + at[k][:, w].view(np.uint64))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cell.view(np.int64)), pa.array(reps[rows]),
                             pa.array(np.full(len(rows), not any(way))),
                             pa.array(sketch[:, 0]), pa.array(sketch[:, 1])],
                            ["cell", "rep", "home", "s1", "s2"])
    return run


def _verify(min_cosine: float):
    def run(batches):
        for b in batches:
            u, v = b.column("u").to_pylist(), b.column("v").to_pylist()
            near = np.zeros(len(u), bool)
            for i, (x, y) in enumerate(zip(u, v, strict=True)):
                if len(x) == len(y):
                    x, y = np.array(x, np.float64), np.array(y, np.float64)
                    x, y = x / np.abs(x).max(), y / np.abs(y).max()
                    near[i] = x @ y >= min_cosine * np.sqrt((x @ x) * (y @ y))
            keep = pa.array(near)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)],
                                             ["a", "b"])
    return run


def classes(vectors: DataFrame) -> DataFrame:
    """(vec, rep, copies) of the usable vectors, equal ones together."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.where(F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(True))
                           & F.exists("vec", lambda x: x != 0) & F.col("vec_id").isNotNull())
    return usable.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))


def links(distinct: DataFrame, *, min_cosine: float = MIN_COSINE, tables: int = TABLES,
          blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE,
          max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """(a, b) with a < b: linked classes of (vec, rep)."""
    places = distinct.select("rep", "vec").mapInArrow(
        _places(tables, blocks, probes, scale, seed),
        "cell bigint, rep bigint, home boolean, s1 bigint, s2 bigint")
    stands = places.where("home").select("cell", F.col("rep").alias("a"), F.col("s1").alias("a1"),
                                         F.col("s2").alias("a2"))
    differ = F.bit_count(F.col("a1").bitwiseXOR(F.col("s1"))) + F.bit_count(F.col("a2").bitwiseXOR(F.col("s2")))
    pairs = (stands.join(places, (stands["cell"] == places["cell"]) & (F.col("a") != F.col("rep"))
                         & (~F.col("home") | (F.col("a") < F.col("rep"))) & (differ <= max_bits))
             .select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct())
    vec = distinct.select("rep", "vec")
    both = (pairs.join(vec.select(F.col("rep").alias("a"), F.col("vec").alias("u")), "a")
            .join(vec.select(F.col("rep").alias("b"), F.col("vec").alias("v")), "b")
            .select("a", "b", "u", "v"))
    return both.mapInArrow(_verify(min_cosine), "a bigint, b bigint")


def near_duplicates(embeddings: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
                    **options) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept, class_id.

    ``n_links``: other rows linked directly, equal vectors included;
    ``component_id``: smallest id reachable; ``kept``: it is its own.
    """
    src = pick(embeddings, vec_id=id_col, vec=vec_col).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))
    distinct = anchored(classes(src))
    found = anchored(links(distinct, **options))
    component = connected_components(found)
    copies = distinct.select(F.col("rep").alias("b"), "copies")
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    n = both.join(copies, "b").groupBy(F.col("a").alias("rep")).agg(F.sum("copies").alias("others"))
    by_class = (distinct.join(n, "rep", "left").join(component.withColumnRenamed("node", "rep"), "rep", "left")
                .select("vec", F.col("rep").alias("class_id"),
                        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id")))
    rows = src.join(by_class, "vec", "left")
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                       F.coalesce("component_id", "vec_id").alias("component_id"),
                       F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True))
                       .alias("kept"), F.coalesce("class_id", "vec_id").alias("class_id"))
