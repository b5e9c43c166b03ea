"""Raw → bronze for news and daily bars.

Both transforms work the same way: check the raw columns, keep the latest
fetch of each record, and read the bronze row off the table's schema.  The
dedup is the only shuffle, with a map-side partial step.  A missing raw
column fails at analysis time, before any data is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas as S
from ..functions import timecols
from .dedup import latest_per_key

PIPELINE_NAME = "raw_to_bronze_news"
BARS_PIPELINE_NAME = "raw_to_bronze_bars"

# Bronze columns that go by another name in raw.
RAW_NAMES = {"news_source": "source"}

# What makes two raw records the same one.  The stored key has 64 bits only,
# so records are grouped by the fields it was made of as well.
NEWS_IDENTITY = ("dedup_key", "symbol", "datetime", "url")
BAR_IDENTITY = ("dedup_key", "symbol", "date")
LATEST_FETCH = ("fetched_at", "id")


class SchemaDriftError(ValueError):
    """Raised when the raw input lacks a column the bronze select pins."""


def check_columns(df: DataFrame, required) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaDriftError(f"raw input lacks columns: {missing}")


def _clock(ingestion_ts: Column | str | None) -> Column:
    if ingestion_ts is None:
        return F.current_timestamp()
    return ingestion_ts if isinstance(ingestion_ts, Column) else F.lit(ingestion_ts).cast("timestamp")


def _to_bronze(raw: DataFrame, schema: StructType, identity, computed: dict[str, Column],
               needs: tuple[str, ...], dedup_order) -> DataFrame:
    """Latest record per identity, then one column per schema field: computed,
    or the raw column of that name, in the schema's type (bad text → null)."""
    taken = [RAW_NAMES.get(f.name, f.name) for f in schema.fields if f.name not in computed]
    required = list(dict.fromkeys([*identity, *needs, *taken]))
    check_columns(raw, required)
    order = [c for c in dedup_order if c in raw.columns]
    rows = raw.select(*dict.fromkeys([*required, *order]))
    rows = latest_per_key(rows, list(identity), order) if order else rows.dropDuplicates(list(identity))

    def value(f) -> Column:
        made = computed.get(f.name)
        return (F.col(RAW_NAMES.get(f.name, f.name)) if made is None else made).try_cast(f.dataType)

    return rows.select(*[value(f).alias(f.name) for f in schema.fields])


def bronze_news(raw: DataFrame, ingestion_ts: Column | str | None = None,
                pipeline: str = PIPELINE_NAME, dedup_order=LATEST_FETCH) -> DataFrame:
    """The raw → bronze transform of one batch of raw news.

    ``published_at`` comes from epoch seconds and the ``event_*`` parts from
    its UTC day; ``_ingestion_ts`` is the clock unless a value is passed.  Of
    several fetches of an article the latest (``fetched_at``, then ``id``)
    stays; only raw still carries the fetch time, so dedup comes first.
    """
    published = timecols.epoch_seconds_to_timestamp("datetime")
    parts = dict(zip(("event_year", "event_month", "event_day"),
                     timecols.date_parts(timecols.utc_wall_clock(published)), strict=True))
    return _to_bronze(raw, S.BRONZE_NEWS, NEWS_IDENTITY,
                      {"published_at": published, **parts, "_ingestion_ts": _clock(ingestion_ts),
                       "_pipeline": F.lit(pipeline)}, ("datetime",), dedup_order)


def bronze_bars(raw: DataFrame, ingestion_ts: Column | str | None = None,
                pipeline: str = BARS_PIPELINE_NAME, dedup_order=LATEST_FETCH) -> DataFrame:
    """The raw → bronze transform of one batch of daily bars (all text in raw):
    typed prices and volume, one row per symbol and day, the latest fetch."""
    day = F.col("date").try_cast("date")
    return _to_bronze(raw, S.BRONZE_BARS, BAR_IDENTITY,
                      {"bar_date": day, "event_year": F.year(day), "event_month": F.month(day),
                       "_ingestion_ts": _clock(ingestion_ts), "_pipeline": F.lit(pipeline)},
                      ("date",), dedup_order)
