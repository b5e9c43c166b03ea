"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test strings are word windows: every run of ``window`` consecutive words of
a benchmark item (an item with fewer words, but not none, is one window).
The symbols of the search are words.  A block is the last ``BLOCK`` words of
a position; the block shift table says how far the search may jump when the
block can't end a test string, so most positions are never looked at; a
block that can end one selects a suffix bucket, whose test strings are then
compared word by word.

Test strings of one length share one matcher.  The benchmark is read in
pieces of at most ``shard_bytes`` of text (a row larger than that is a piece
of its own); each piece's matchers are shipped to the tasks and the documents
are scanned once a piece, so memory doesn't grow with the benchmark.  The
documents themselves are never shuffled.

Null texts have no words.  Null item ids are written ``null``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import anchored, pick, release_model, utf8, whole_row

WINDOW = 13
BLOCK = 2
SHARD_BYTES = 16 << 20
PIECES_PER_PASS = 4

# Lower-case A-Z; everything else that is no word character becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def bench_words(text: str | None) -> list[bytes]:
    return utf8(text).translate(_FOLD).split()


class Matcher:
    """Wu-Manber tables for test strings of ``length`` words."""

    def __init__(self, length: int, strings: dict[tuple, list]):
        self.length = length
        self.block = min(BLOCK, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list[tuple]] = defaultdict(list)
        self.owners = strings
        for s in strings:
            for end in range(self.block, length + 1):
                key = s[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.bucket[s[length - self.block:]].append(s)

    def search(self, ws: list[bytes]) -> Iterator[tuple[int, tuple]]:
        """(start, test string) of every occurrence, overlapping ones too."""
        m, b, n = self.length, self.block, len(ws)
        shift, default, bucket = self.shift, self.default, self.bucket
        end = m
        while end <= n:
            key = tuple(ws[end - b:end])
            jump = shift.get(key, default)
            if jump:
                end += jump
                continue
            got = tuple(ws[end - m:end])
            for s in bucket[key]:
                if s == got:
                    yield end - m, s
            end += 1


def build_matchers(items, window: int = WINDOW) -> list[Matcher]:
    """Matchers, one per test-string length, from (item_id, text) rows."""
    by_len: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        ws = tuple(bench_words(text))
        if not ws:
            continue
        k = min(window, len(ws))
        for i in range(len(ws) - k + 1):
            by_len[k][ws[i:i + k]].add("null" if item is None else str(item))
    return [Matcher(k, {s: sorted(o) for s, o in v.items()}) for k, v in sorted(by_len.items())]


def hits(ws: list[bytes], matchers: list[Matcher]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged half-open word ranges inside occurrences, and the items that occur."""
    spans, items = [], set()
    for m in matchers:
        for at, s in m.search(ws):
            spans.append((at, at + m.length))
            items.update(m.owners[s])
    merged: list[list[int]] = []
    for a, z in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], z)
        else:
            merged.append([a, z])
    return [(a, z) for a, z in merged], items


def _benchmark_pieces(benchmark: DataFrame, item_col: str, text_col: str, shard_bytes: int):
    """Benchmark rows in pieces of bounded bytes; rows arrive one partition at a time."""
    rows = pick(benchmark, item=item_col, text=text_col).where(F.col("text").isNotNull())
    piece, size = [], 0
    for r in rows.toLocalIterator():
        n = len(r.text)
        if piece and size + n > shard_bytes:
            yield piece
            piece, size = [], 0
        piece.append((r.item, r.text))
        size += n
    yield piece


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
                       carry: bool = False) -> DataFrame:
    """One row per document row: doc_id, n_words, hit word ranges, item ids.

    ``hit_ranges`` array<struct<start,end>> in words, merged, end exclusive;
    ``items`` sorted distinct item ids; with ``carry`` also ``row``, all columns of the
    input.  Repeated rows give repeated rows, and an empty benchmark gives rows
    without hits.  Each benchmark piece adds one Python step to the scan;
    after every ``PIECES_PER_PASS`` pieces the rows are written and reread.
    """
    spark = docs.sparkSession
    # the text goes to Python once: alone, or within the row
    out = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                      whole_row(docs).alias("row") if carry else F.col(f"`{text_col}`").alias("_text"),
                      F.lit(0).cast("bigint").alias("n_words"),
                      F.expr("cast(array() as array<bigint>)").alias("_flat"),
                      F.expr("cast(array() as array<string>)").alias("items"))
    for k, piece in enumerate(_benchmark_pieces(benchmark, item_col, item_text_col, shard_bytes)):
        if k and k % PIECES_PER_PASS == 0:
            out = anchored(out)
        shipped = spark.sparkContext.broadcast(piece)

        def scan(batches, shipped=shipped):
            release_model()
            matchers = build_matchers(shipped.value, window)
            for b in batches:
                ns, flats, found = [], [], []
                texts = b.column("row").field(text_col) if carry else b.column("_text")
                for text, flat, items in zip(texts, b.column("_flat").to_pylist(),
                                             b.column("items").to_pylist(), strict=True):
                    ws = bench_words(text.as_py())
                    spans, new = hits(ws, matchers)
                    ns.append(len(ws))
                    flats.append(flat + [x for s in spans for x in s])
                    found.append(sorted({*items, *new}))
                done = {"n_words": pa.array(ns, pa.int64()),
                        "_flat": pa.array(flats, pa.list_(pa.int64())),
                        "items": pa.array(found, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays(
                    [done.get(n, b.column(i)) for i, n in enumerate(b.schema.names)], b.schema.names)

        out = out.mapInArrow(scan, out.schema)
    ranges = F.array_sort(F.expr(
        "transform(filter(sequence(0, size(_flat)), i -> i % 2 = 0 and i < size(_flat)), "
        "i -> struct(_flat[i] as start, _flat[i + 1] as end))"))
    return out.select("doc_id", "n_words", _merge_ranges(ranges).alias("hit_ranges"), "items",
                      *["row"][:carry])


def _merge_ranges(sorted_ranges):
    """Ranges of several pieces may overlap: merged as one sorted list."""
    kind = "array<struct<start:bigint,end:bigint>>"

    def step(acc, r):
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (r["start"] <= F.when(F.size(acc) > 0, last["end"]))
        grown = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                         F.array(F.struct(last["start"].alias("start"),
                                          F.greatest(last["end"], r["end"]).alias("end"))))
        return F.when(joins, grown).otherwise(F.concat(acc, F.array(r)))

    return F.aggregate(sorted_ranges, F.expr(f"cast(array() as {kind})"),
                       lambda a, r: step(a, r).cast(kind))


def contamination(docs: DataFrame, benchmark: DataFrame, *, min_parts: int = 20,
                  **options) -> DataFrame:
    """The decision of each document: contaminated when at least one word in
    ``min_parts`` lies inside an occurrence of a test string (and one does)."""
    found = find_contamination(docs, benchmark, **options)
    n_hit = F.aggregate("hit_ranges", F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["start"])
    return (found.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0)
                        & (F.col("n_hit") * min_parts >= F.col("n_words"))))
