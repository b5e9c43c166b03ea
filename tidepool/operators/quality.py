"""Data-quality rules — extension (X11).

Rules of one table are evaluated together in a single aggregate pass (one
scan, partial aggregation); referential rules are left-anti joins against
the referenced keys.  Output: one row per rule with rows checked, rows
failed and a pass flag.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str            # completeness | range | uniqueness | referential
    column: str
    predicate: Column | None = None      # row passes when true (completeness/range)
    ref: DataFrame | None = None         # referenced table (referential)
    ref_column: str | None = None


def not_null(name: str, column: str) -> Rule:
    return Rule(name, "completeness", column, F.col(column).isNotNull())


def in_range(name: str, column: str, lo=None, hi=None) -> Rule:
    c = F.col(column)
    p = F.lit(True)
    if lo is not None:
        p = p & (c >= F.lit(lo))
    if hi is not None:
        p = p & (c <= F.lit(hi))
    return Rule(name, "range", column, p)


def unique(name: str, column: str) -> Rule:
    return Rule(name, "uniqueness", column)


def references(name: str, column: str, ref: DataFrame, ref_column: str) -> Rule:
    return Rule(name, "referential", column, ref=ref, ref_column=ref_column)


def _result(name: str, checked: Column, failed: Column):
    return F.struct(F.lit(name).alias("rule"), checked.cast("bigint").alias("checked"),
                    failed.cast("bigint").alias("failed"))


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Evaluate ``rules`` on ``df``; returns ``rule, checked, failed, passed``."""
    local = [r for r in rules if r.kind != "referential"]
    parts = []
    if local:
        exprs = []
        n = F.count(F.lit(1))
        for r in local:
            if r.kind == "uniqueness":
                # duplicates = non-null rows beyond the first of each value
                exprs.append(_result(r.name, n, F.count(r.column) - F.count_distinct(r.column)))
            else:
                exprs.append(_result(r.name, n, F.count_if(~F.coalesce(r.predicate, F.lit(False)))))
        row = df.agg(F.array(*exprs).alias("r"))
        parts.append(row.select(F.explode("r").alias("x")).select("x.*"))
    for r in rules:
        if r.kind != "referential":
            continue
        keys = r.ref.select(F.col(r.ref_column).alias("__k")).distinct() \
            .withColumn("__hit", F.lit(True))
        # one row per foreign key and task reaches the shuffle, not the fact rows
        vals = (df.select(F.col(r.column).alias("__k")).where(F.col("__k").isNotNull())
                  .groupBy("__k").agg(F.count(F.lit(1)).alias("__n")))
        zero = F.lit(0).cast("bigint")
        parts.append(vals.join(keys, "__k", "left")
                         .agg(F.coalesce(F.sum("__n"), zero).alias("checked"),
                              F.coalesce(F.sum(F.when(F.col("__hit").isNull(), F.col("__n"))), zero)
                              .alias("failed"))
                         .select(F.lit(r.name).alias("rule"), "checked", "failed"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failed") == 0)
