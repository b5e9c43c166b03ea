"""Text, hashing and table helpers shared by the training-data operators.

Words here are what the contracts call words: maximal runs of bytes other
than ASCII white space, after lower-casing A-Z only.  ``bytes.lower`` and
``bytes.split`` do exactly that on the UTF-8 form, and leave every
non-ASCII character alone.
"""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterable, Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, reliable_checkpoint

__all__ = ["Hasher", "anchored", "checkpoint_dir", "combine", "kept_model", "mix64", "pick", "release_model",
           "reliable_checkpoint", "rows_of", "scratch_path", "ship_package", "table", "utf8", "whole_row",
           "words"]

WORD_CACHE = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that their
    Python finds it wherever they run (``addPyFile`` serves it from the driver)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under fixed names: other columns can't clash."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in cols.items()])


def whole_row(df: DataFrame):
    """All columns as one struct: carried through a job under one name, they
    can't clash with the job's own columns."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid4().hex}"


def anchored(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read back: lineage cut,
    and the rows no longer depend on any executor."""
    return reliable_checkpoint(df)


_MODEL: dict[Hashable, object] = {}


def kept_model(key: Hashable, make: Callable[[], object]):
    """The model that this process keeps from task to task: one at a time."""
    if key not in _MODEL:
        release_model()
        _MODEL[key] = make()
    return _MODEL[key]


def release_model() -> None:
    """Give up a model kept by another operator's stage, and Arrow's unused memory:
    Spark reuses a worker for all stages of a session."""
    if _MODEL:
        _MODEL.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    return utf8(text).lower().split()


class Hasher(dict):
    """word -> 64-bit xxHash, remembering a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = h
        return h

    def array(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), dtype=np.uint64, count=len(ws))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (two rounds of xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def combine(parts: Iterable[np.ndarray]) -> np.ndarray:
    """One 64-bit value for a sequence of 64-bit values, order kept."""
    out = None
    for p in parts:
        out = mix64(p) if out is None else mix64(out * np.uint64(0xA24BAED4963EE407) + p)
    return out


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Python tuples of the named columns."""
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names), strict=True)
