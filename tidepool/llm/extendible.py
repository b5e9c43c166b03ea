"""Sharding by extendible hashing, in DataFrame operations only.

Every row has a bit string, the hash of its key.  A bucket is a prefix of it.
The directory starts with the empty prefix; only a bucket beyond
``limit_bytes`` is split on one more bit, until every bucket fits.  So small
buckets stay whole, and where a heavy part of the key space is split further,
the rest of the directory doesn't move.

Splitting goes by levels of ``LEVEL`` bits.  At each level the rows of the
buckets still too large are added up by their next bits (partial sums before
the shuffle, at most ``2 ** LEVEL`` cells per such bucket), and all depths
within the level are settled on these sums.  The driver sees one number a level.

The hash is md5 of the key, the row's bytes and its copy number: rows that are
equal in these are counted together and dealt out again with numbers 0, 1, ...,
so that a key with a third of all rows splits as well as any other.  A single
row beyond the limit can't be split: it gets a bucket of its own, marked
``oversized``.  Null texts have 0 bytes; null keys are a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import anchored

LEVEL = 12          # bits a level; three hexadecimal digits
LEVELS = 10         # 120 of md5's 128 bits
LIMIT_BYTES = 8 << 20


def _hex(key: Column, n_bytes: Column, copy: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("\0null")),
                             n_bytes.cast("string"), copy.cast("string")).cast("binary"))


def _bits(hex_digits: Column) -> Column:
    return F.lpad(F.conv(hex_digits, 16, 2), LEVEL, "0")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, n_bytes, copy, hex), one row per document row."""
    n_bytes = F.octet_length(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).cast("bigint")
    counted = (docs.select(F.col(f"`{id_col}`").alias("key"), n_bytes.alias("n_bytes"))
               .groupBy("key", "n_bytes").agg(F.count("*").alias("copies")))
    return (counted.select("key", "n_bytes", F.explode(F.expr("sequence(0L, copies - 1)")).alias("copy"))
            .withColumn("hex", _hex(F.col("key"), F.col("n_bytes"), F.col("copy"))))


def _settle(cells: DataFrame, limit_bytes: int) -> DataFrame:
    """(parent, cell, depth): the fewest bits of this level at which the cell's
    bucket fits; null when even all of them are too few."""
    depths = cells.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(LEVEL))))
    prefix = F.expr("substring(cell, 1, d)")
    sums = (depths.groupBy("parent", "d", prefix.alias("prefix"))
            .agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") <= limit_bytes))
    fits = (depths.withColumn("prefix", prefix).select("parent", "cell", "d", "prefix")
            .join(sums, ["parent", "d", "prefix"]).groupBy("parent", "cell").agg(F.min("d").alias("depth")))
    return cells.select("parent", "cell").join(fits, ["parent", "cell"], "left")


def directory(rows: DataFrame, limit_bytes: int = LIMIT_BYTES) -> list[DataFrame]:
    """One table a level: (parent, cell, depth); ``parent`` is the hexadecimal
    prefix of the levels before, ``cell`` this level's bits, ``depth`` how many
    of them name the shard (null: go on to the next level)."""
    levels: list[DataFrame] = []
    left = rows.select("hex", "n_bytes")
    for level in range(LEVELS):
        digits = LEVEL // 4
        parent = F.substring("hex", 1, level * digits)
        cell = _bits(F.substring("hex", level * digits + 1, digits))
        if level:
            # only the rows of buckets that are still too large
            open_ = (levels[-1].where("depth is null")
                     .select(F.concat("parent", F.lpad(F.conv("cell", 2, 16), digits, "0")).alias("_open")))
            left = left.join(open_, F.lower("_open") == parent, "left_semi")
        cells = left.groupBy(parent.alias("parent"), cell.alias("cell")).agg(F.sum("n_bytes").alias("bytes"))
        found = anchored(_settle(cells, limit_bytes))
        levels.append(found)
        if found.where("depth is null").isEmpty():
            break
    return levels


def assign(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """One row per document row: key, copy, n_bytes, shard (its bits), shard_bytes,
    oversized.  The one shard of a table that fits is named by no bits at all."""
    rows = anchored(keyed(docs, id_col, text_col))
    placed = rows.withColumn("shard", F.lit(None).cast("string"))
    digits = LEVEL // 4
    levels = directory(rows, limit_bytes)
    for i, level in enumerate(levels):
        here = _bits(F.substring("hex", i * digits + 1, digits))
        before = F.concat(F.lit(""), *[_bits(F.substring("hex", j * digits + 1, digits)) for j in range(i)])
        last = F.lit(LEVEL if i == len(levels) - 1 else None).cast("int")
        side = level.select(F.col("parent").alias("_p"), F.col("cell").alias("_c"),
                            F.coalesce("depth", last).alias("_d"))
        placed = (placed.join(side, (F.substring("hex", 1, i * digits) == F.col("_p")) & (here == F.col("_c")),
                              "left")
                  .withColumn("shard", F.coalesce("shard", F.concat(before, F.expr("substring(_c, 1, _d)"))))
                  .drop("_p", "_c", "_d"))
    sizes = placed.groupBy(F.col("shard").alias("_shard")).agg(F.sum("n_bytes").alias("shard_bytes"))
    return (placed.join(sizes, F.col("shard") == F.col("_shard"))
            .select("key", "copy", "n_bytes", "shard", "shard_bytes",
                    (F.col("shard_bytes") > limit_bytes).alias("oversized")))


def write(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
          limit_bytes: int = LIMIT_BYTES, shard_col: str = "shard") -> None:
    """Write the rows as Parquet, one folder per shard.

    Rows join their shard by key and bytes; a key with copies is dealt out by
    copy number, so only such rows are numbered (after they are counted out,
    all columns taken together).
    """
    placed = assign(docs, id_col=id_col, text_col=text_col, limit_bytes=limit_bytes)
    n_bytes = F.octet_length(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).cast("bigint")
    many = placed.where("copy > 0").select(F.col("key").alias("_k"), F.col("n_bytes").alias("_n")).distinct()
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_k")) & (n_bytes == F.col("_n"))
    single = docs.join(many, same, "left_anti")
    copies = docs.join(many, same, "left_semi")
    names = [F.col(f"`{c}`") for c in docs.columns]
    by = Window.partitionBy(f"`{id_col}`", n_bytes)
    numbered = (copies.groupBy(*names).agg(F.count("*").alias("_c"))
                .withColumn("_before", F.sum("_c").over(by.orderBy(F.xxhash64(*names)).rowsBetween(
                    Window.unboundedPreceding, -1)))
                .withColumn("_copy", F.explode(F.expr(
                    "sequence(coalesce(_before, 0L), coalesce(_before, 0L) + _c - 1)")))
                .drop("_c", "_before"))
    rows = single.withColumn("_copy", F.lit(0).cast("bigint")).unionByName(numbered)
    side = placed.select(F.col("key").alias("_k"), F.col("n_bytes").alias("_n"),
                         F.col("copy").alias("_i"), F.col("shard").alias(f"{shard_col}"))
    out = rows.join(side, same & (F.col("_copy") == F.col("_i"))).select(*names, F.concat(
        F.lit("p"), F.col(shard_col)).alias(shard_col))
    out.repartition(shard_col).write.partitionBy(shard_col).parquet(path)
