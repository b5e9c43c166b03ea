"""Row filters and record classification.

All predicates are plain Column expressions so Catalyst can push them into
the scan (``PushedFilters``) or, for partition columns, prune whole
directories (``PartitionFilters``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import PROJECTION_YEARS, TRADE_TYPE
from ..schemas import CORRUPT_COL


def only_type(df: DataFrame, type_col: str = "type", value: str = TRADE_TYPE) -> DataFrame:
    """keep messages of one type (``type = 'trade'`` for the tick relay)."""
    return df.where(F.col(type_col) == F.lit(value))


def split_malformed(df: DataFrame, corrupt_col: str = CORRUPT_COL) -> tuple[DataFrame, DataFrame]:
    """(good, bad) by the corrupt-record column a PERMISSIVE read fills.

    A frame read without the corrupt column has no malformed rows.  Spark
    refuses queries that touch *only* the corrupt column of a raw JSON scan,
    so callers that read files should ``cache`` or select data columns too.
    """
    if corrupt_col not in df.columns:
        return df, df.limit(0)
    good = df.where(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = df.where(F.col(corrupt_col).isNotNull())
    return good, bad


# Payload status values.
SERIES_OK, RATE_LIMITED, UNEXPECTED = "ok", "rate_limited", "unexpected"


def in_date_range(df: DataFrame, ts_col: str, today: str | _dt.date, days_back: int = 1) -> DataFrame:
    """rows whose date is in ``[today - days_back, today]`` (inclusive).

    ``today`` is a parameter, never the wall clock, so reruns are repeatable.
    """
    d = F.lit(str(today)).cast("date")
    day = F.to_date(F.col(ts_col))
    return df.where(day.between(F.date_sub(d, days_back), d))


def partition_predicate(symbols: Sequence[str] | None = None, year: int | None = None,
                        month: int | None = None, day: int | None = None,
                        symbol_col: str = "symbol") -> Column:
    """a predicate on partition columns (pruned from the file listing)."""
    cond = F.lit(True)
    if symbols is not None:
        cond = cond & F.col(symbol_col).isin(list(symbols))
    for name, v in (("year", year), ("month", month), ("day", day)):
        if v is not None:
            cond = cond & (F.col(name) == F.lit(v))
    return cond


def in_projection_domain(df: DataFrame, symbols: Sequence[str], symbol_col: str = "symbol",
                         year_col: str | None = "year", ts_col: str | None = None,
                         years=PROJECTION_YEARS) -> DataFrame:
    """rows a projected table can see: symbol in the enum and year in range.

    ``symbols`` is the configured list (``keys.parse_ticker_list`` reads its
    text), so the test is an ``IN`` that reaches the scan; with ``ts_col`` the
    years become a range of times, which reaches it too.  Months, days and
    hours of the projection cover the whole calendar and test nothing.
    """
    seen = F.col(symbol_col).isin(list(symbols))
    if ts_col is None:
        return df.where(seen & F.col(year_col).between(years[0], years[1]))
    kind = df.schema[ts_col].dataType
    lo, hi = (F.lit(f"{y}-01-01 00:00:00").cast(kind) for y in (years[0], years[1] + 1))
    return df.where(seen & (F.col(ts_col) >= lo) & (F.col(ts_col) < hi))
