"""Toxicity score: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text, each present or not: its words (letters and digits, A-Z
lower-cased), neighbouring pairs, pairs that skip one word, and the beginnings
of longer words, so that inflected forms share a weight.  Their 64-bit hashes
are folded into ``dims`` coordinates; the texts themselves are the only input.
A long text switches on many coordinates by chance, so scoring counts a
coordinate only for a feature that the training rows hold too (``seen``, a
Bloom filter of fixed size, so that it is broadcast whatever the texts'
length): a text of new words scores as an empty one, but for the filter's few
false hits.

Training reads a bounded sample: the ``max_rows`` labelled rows with the
smallest md5 of their id.  The rows are dealt over ``shards`` tasks by id
hash.  In every round each task goes once through its rows from the common
state (per-coordinate sums z and n), and the tasks' changes are averaged, by
ranges of coordinates on the executors, into the next state.  Per-coordinate
rates come from n, and the L1 term keeps most weights at zero.  What passes
through the driver is bounded by ``dims`` (twelve bytes a coordinate and
round) and the filter's size.

Null and empty texts get the score of the bias alone; very long ones count
whole.  Labels other than 0 and 1 are not trained on; without training rows
every score is 0.5.  Repeated documents are trained on and scored each by
itself, an id labelled differently takes the larger label.  An empty table
gives no rows, and columns other than the named ones are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, anchored, combine, mix64, pick
from .wu_manber import bench_words

DIMS = 1 << 20
SHARDS = 4
ROUNDS = 8
MAX_ROWS = 24_000
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.0, 0.3
RANGE = 1 << 16
# the filter of features seen in training: 256 parts of 2^19 bits, 16 MiB
SEEN_PARTS, SEEN_BITS, PROBES = 256, 1 << 19, 4
STEM = 4
THRESHOLD = 0.3


def hashes(text: str | None, hasher: Hasher, stems: Hasher) -> np.ndarray:
    """64-bit hashes of a text's features."""
    ws = bench_words(text)
    if not ws:
        return np.empty(0, np.uint64)
    h = hasher.array(ws)
    beginnings = {w[:STEM] for w in ws if len(w) > STEM} | {w[:STEM + 2] for w in ws if len(w) > STEM + 2}
    return np.concatenate([h, combine((h[:-1], h[1:])), combine((h[:-2] ^ np.uint64(0x5BD1E995), h[2:])),
                           stems.array([b"^" + b for b in beginnings])])


def coordinates(h: np.ndarray, dims: int) -> np.ndarray:
    """Coordinates of hashed features; coordinate 0 is the bias."""
    return (h % np.uint64(dims - 1)).astype(np.int64) + 1


def features(text: str | None, hasher: Hasher, stems: Hasher, dims: int = DIMS) -> np.ndarray:
    """Distinct coordinates of a text, with the bias."""
    return np.concatenate(([0], np.unique(coordinates(hashes(text, hasher, stems), dims))))


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of the state: zero where |z| stays below the L1 bound."""
    return np.where(np.abs(z) <= L1, 0.0,
                    -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def probability(w_sum):
    return 1.0 / (1.0 + np.exp(-np.clip(w_sum, -35, 35)))


def learn(rows: list[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass over (coordinates, label), changing the state in place."""
    for idx, y in rows:
        zi, ni = z[idx], n[idx]
        w = weights(zi, ni)
        g = probability(w.sum()) - y
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
        z[idx] = zi + g - sigma * w
        n[idx] = ni + g * g


def _packed(idx: np.ndarray) -> bytes:
    """Sorted coordinates as compressed gaps."""
    return zlib.compress(np.diff(idx, prepend=0).astype(np.int32).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.int32))


def _featurise(dims: int):
    def run(batches):
        hasher, stems = Hasher(), Hasher()
        for b in batches:
            idx = [_packed(features(t.as_py(), hasher, stems, dims)) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("shard"), b.column("ord"), b.column("label"), pa.array(idx, pa.binary())],
                ["shard", "ord", "label", "idx"])
    return run


def _pass(state, dims: int):
    """The changes that one pass over each shard of the task makes, a row a range
    of coordinates: twelve bytes for each that moved."""
    def run(batches):
        now = None

        def change():
            moved = np.flatnonzero((z != z0) | (n != n0))
            cuts = np.flatnonzero(np.diff(moved // RANGE)) + 1
            rows = [(int(i[0] // RANGE), now, i.astype(np.int32).tobytes(),
                     (z - z0)[i].astype(np.float32).tobytes(), (n - n0)[i].astype(np.float32).tobytes())
                    for i in np.split(moved, cuts) if len(i)]
            return pa.RecordBatch.from_pylist([dict(zip(CHANGE.names, r, strict=True)) for r in rows], CHANGE)

        z0, n0 = state.value
        z, n = z0.copy(), n0.copy()
        for b in batches:
            for shard, label, idx in zip(b.column("shard").to_pylist(), b.column("label").to_pylist(),
                                         b.column("idx").to_pylist(), strict=True):
                if now is not None and shard != now:
                    yield change()
                    z, n = z0.copy(), n0.copy()
                now = shard
                learn([(_unpacked(idx), label)], z, n)
        if now is not None:
            yield change()
    return run


CHANGE = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("idx", pa.binary()), ("dz", pa.binary()),
                    ("dn", pa.binary())])


def _averaged(shards: int):
    """The mean of the shards' changes to one range of coordinates."""
    def run(changes: pa.Table) -> pa.Table:
        rows = sorted(changes.to_pylist(), key=lambda r: r["shard"])
        dz, dn = np.zeros(RANGE), np.zeros(RANGE)
        start = rows[0]["part"] * RANGE
        for r in rows:
            i = np.frombuffer(r["idx"], np.int32) - start
            dz[i] += np.frombuffer(r["dz"], np.float32)
            dn[i] += np.frombuffer(r["dn"], np.float32)
        i = np.flatnonzero((dz != 0) | (dn != 0))
        return pa.table({"idx": pa.array([(i + start).astype(np.int32).tobytes()], pa.binary()),
                         "dz": pa.array([(dz[i] / shards).astype(np.float32).tobytes()], pa.binary()),
                         "dn": pa.array([(dn[i] / shards).astype(np.float32).tobytes()], pa.binary())})
    return run


def _places(h: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Part of the filter and the probed bits in it, for hashed features."""
    x = mix64(h)
    y = mix64(x ^ np.uint64(0x2545F4914F6CDD1D))
    low, next_ = np.uint64(SEEN_BITS - 1), np.uint64(SEEN_BITS.bit_length() - 1)
    bits = [x & low, (x >> next_) & low, y & low, (y >> next_) & low][:PROBES]
    return (x >> np.uint64(56)).astype(np.int64) % SEEN_PARTS, [b.astype(np.int64) for b in bits]


def held(seen: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashed features the filter holds."""
    part, bits = _places(h)
    out = np.ones(len(h), bool)
    for b in bits:
        out &= (seen[part * (SEEN_BITS // 8) + (b >> 3)] >> (b & 7).astype(np.uint8)) & 1 == 1
    return out


def _hashes_at(on, dims: int):
    """(part, h): distinct hashes of a batch's features at the coordinates ``on``."""
    def run(batches):
        hasher, stems = Hasher(), Hasher()
        wanted = np.zeros(dims, bool)
        wanted[on.value] = True
        for b in batches:
            got = [np.empty(0, np.uint64)]
            for t in b.column("text"):
                h = hashes(t.as_py(), hasher, stems)
                got.append(np.unique(h[wanted[coordinates(h, dims)]]))
            h = np.unique(np.concatenate(got))
            yield pa.RecordBatch.from_arrays([pa.array(_places(h)[0].astype(np.int32)), pa.array(h.view(np.int64))],
                                             ["part", "h"])
    return run


def _filter_parts(batches):
    """(part, bits) of the filter's parts that meet in this task."""
    parts: dict[int, np.ndarray] = {}
    for b in batches:
        which = b.column("part").to_numpy()
        _, bits = _places(b.column("h").to_numpy().view(np.uint64))
        for part in np.unique(which).tolist():
            own = parts.setdefault(part, np.zeros(SEEN_BITS // 8, np.uint8))
            for x in bits:
                at = x[which == part]
                np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
    for part, own in parts.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([own.tobytes()], pa.binary())],
                                         ["part", "bits"])


def train(docs: DataFrame, labels: DataFrame, **options) -> np.ndarray:
    """The weights alone (see ``fit``)."""
    return fit(docs, labels, **options)[0]


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", dims: int = DIMS, shards: int = SHARDS, rounds: int = ROUNDS,
        max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (``dims`` floats) learned from the labelled documents, and the
    filter of the training rows' features whose weight isn't zero.

    An id labelled more than once takes its largest label; ids in ``labels``
    without a document are ignored.
    """
    spark = docs.sparkSession
    sample = (pick(labels, doc_id=id_col, label=label_col).where("doc_id is not null and label in (0, 1)")
              .groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
              .withColumn("ord", F.md5(F.col("doc_id").cast("string").cast("binary")))
              .orderBy("ord").limit(max_rows)
              .withColumn("shard", F.expr(f"cast(pmod(xxhash64(ord), {shards}) as int)")))
    # at most max_rows short rows
    sample = F.broadcast(anchored(sample))
    texts = (pick(docs, doc_id=id_col, text=text_col).join(sample, "doc_id")
             .select("shard", "ord", "label", "text"))
    rows = (texts.mapInArrow(_featurise(dims), "shard int, ord string, label int, idx binary"))
    rows = anchored(rows.repartition(shards, "shard").sortWithinPartitions("shard", "ord"))
    z, n = np.zeros(dims), np.zeros(dims)
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z, n))
        changes = rows.mapInArrow(_pass(state, dims), "part int, shard int, idx binary, dz binary, dn binary")
        merged = changes.groupBy("part").applyInArrow(_averaged(shards), "idx binary, dz binary, dn binary").collect()
        for r in merged:  # together at most twelve bytes a coordinate
            i = np.frombuffer(r.idx, np.int32)
            z[i] += np.frombuffer(r.dz, np.float32)
            n[i] += np.frombuffer(r.dn, np.float32)
        state.destroy()
        del merged
    w = weights(z, n).astype(np.float32)
    on = spark.sparkContext.broadcast(np.flatnonzero(w).astype(np.int32))
    # of at most max_rows texts, only features at the weights that L1 leaves
    parts = (texts.select("text").mapInArrow(_hashes_at(on, dims), "part int, h bigint").repartition("part")
             .mapInArrow(_filter_parts, "part int, bits binary"))
    seen = np.zeros(SEEN_PARTS * SEEN_BITS // 8, np.uint8)
    for r in parts.collect():  # the filter: 16 MiB
        seen[r.part * (SEEN_BITS // 8):(r.part + 1) * (SEEN_BITS // 8)] = np.frombuffer(r.bits, np.uint8)
    on.destroy()
    return w, seen


def score(docs: DataFrame, w: np.ndarray, seen: np.ndarray | None = None, *, id_col: str = "doc_id",
          text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row; the whole text counts.  With
    ``seen`` (a filter of features) only what it holds does."""
    at = np.flatnonzero(w).astype(np.int32)
    sent = docs.sparkSession.sparkContext.broadcast((len(w), at, w[at], seen))

    def run(batches):
        dims, on, values, seen = sent.value
        dense = np.zeros(dims, np.float32)
        dense[on] = values
        hasher, stems = Hasher(), Hasher()

        def total(text: str | None) -> float:
            h = hashes(text, hasher, stems)
            if seen is not None:
                h = h[dense[coordinates(h, dims)] != 0]
                h = h[held(seen, h)]
            idx = np.unique(coordinates(h, dims))
            return float(dense[0]) + float(dense[idx].sum(dtype=np.float64))

        for b in batches:
            p = np.array([probability(total(t.as_py())) for t in b.column("text")])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(p, pa.float64()),
                 pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
