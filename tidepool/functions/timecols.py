"""Time conversions as Column expressions.

All of these are built-in expressions, so they stay inside whole-stage
codegen.  Functions that produce a session-zone ``timestamp`` assume the
session zone is UTC (the clocks in the data are UTC); the ``*_ntz``
variants are zone-independent and return wall-clock UTC as
``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .util import as_col


def epoch_seconds_to_timestamp(c) -> Column:
    """Epoch seconds (any type) → ``timestamp``.

    ``try_cast`` keeps Spark-3 behaviour for text such as ``"14a"`` (null,
    not an error under ANSI mode).
    """
    return F.timestamp_seconds(as_col(c).try_cast("bigint"))


def epoch_seconds_to_timestamp_millis(c) -> Column:
    """``TO_TIMESTAMP_LTZ(datetime * 1000, 3)`` – seconds ×1000 as millis."""
    return F.timestamp_millis(as_col(c).try_cast("bigint") * F.lit(1000))


_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_to_ntz(c, unit: str = "SECOND") -> Column:
    """Epoch number → UTC wall clock as ``timestamp_ntz`` (zone-independent)."""
    return F.timestamp_add(unit, as_col(c).try_cast("bigint"), F.expr(_NTZ_EPOCH))


def utc_wall_clock(c) -> Column:
    """``timestamp`` → its UTC wall clock as ``timestamp_ntz``, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(as_col(c)), F.expr(_NTZ_EPOCH))


def to_epoch_seconds(c) -> Column:
    """Timestamp (either flavour) → whole epoch seconds (floor)."""
    return F.unix_timestamp(as_col(c))


def ntz_to_epoch_millis(c) -> Column:
    """``timestamp_ntz`` (UTC wall clock) → epoch milliseconds (floor)."""
    return F.timestamp_diff("MILLISECOND", F.expr(_NTZ_EPOCH), as_col(c))


def date_parts(c, prefix: str = "event_") -> list[Column]:
    """P5: year / month / day-of-month as ``int`` columns."""
    c = as_col(c)
    return [F.year(c).cast("int").alias(f"{prefix}year"),
            F.month(c).cast("int").alias(f"{prefix}month"),
            F.dayofmonth(c).cast("int").alias(f"{prefix}day")]


def padded_path_parts(c, hour: bool = True) -> list[Column]:
    """Zero-padded ``yyyy``/``MM``/``dd``/``HH`` text for partition paths."""
    c = as_col(c)
    parts = [F.date_format(c, "yyyy").alias("year"), F.date_format(c, "MM").alias("month"),
             F.date_format(c, "dd").alias("day")]
    if hour:
        parts.append(F.date_format(c, "HH").alias("hour"))
    return parts


def iso_utc(c) -> Column:
    """P20: ISO-8601 text with offset, like Python's ``datetime.isoformat()``."""
    return F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def ttl_epoch(c, days: int = 30) -> Column:
    """P20: expiry as epoch seconds, ``days`` after the given instant."""
    return (F.unix_timestamp(as_col(c)) + F.lit(days * 86400)).cast("bigint")
