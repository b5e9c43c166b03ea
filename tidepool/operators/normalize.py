"""Producer-side normalisation of landed payloads.

The producers' network loops are not rebuilt (see README); what they do to
the data is: key each record, wrap it in an envelope, flatten nested
payloads and drop non-trade messages.  Here that runs over tables of landed
payloads, one narrow projection per step (no shuffle), so it scales with
the number of payload rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..fixed import (ASSET_CLASS, BAR_COLUMNS, BAR_FIELDS, BARS_SOURCE, DAILY_SERIES_FIELD,
                     NEWS_SOURCE, RATE_LIMIT_FIELDS, TICKS_SOURCE, TRADE_TYPE)
from ..functions import keys
from .filters import RATE_LIMITED, SERIES_OK, UNEXPECTED

NEWS_ENVELOPE = ("source", "asset_class", "symbol", "dedup_key", "fetched_at")


def normalize_news(articles: DataFrame, request_symbol: str = "request_symbol",
                   fetched_at: Column | None = None, source: str = NEWS_SOURCE,
                   asset_class: str = ASSET_CLASS) -> DataFrame:
    """P9 + P11: key each article and wrap it in the envelope; article fields win.

    The key uses the *requested* symbol with the article's ``datetime`` (0 if
    absent) and ``url`` ('' if absent).  An article that carries its own
    ``source``/``symbol``/``dedup_key``/``fetched_at`` overrides the envelope
    value (fixed-schema form: a present non-null article value wins).
    """
    cols = articles.columns
    dt = F.col("datetime") if "datetime" in cols else F.lit(None).cast("bigint")
    url = F.col("url") if "url" in cols else F.lit(None).cast("string")
    env = {
        "source": F.lit(source),
        "asset_class": F.lit(asset_class),
        "symbol": F.col(request_symbol),
        "dedup_key": keys.news_key(F.col(request_symbol), dt, url),
        "fetched_at": fetched_at if fetched_at is not None else F.date_format(
            F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"),
    }
    merged = [(F.coalesce(F.col(k), v) if k in cols else v).alias(k) for k, v in env.items()]
    rest = [F.col(c) for c in cols if c not in env and c != request_symbol]
    return articles.select(*merged, *rest)


def merge_envelope_maps(envelope: Column, article: Column) -> Column:
    """P11, open-ended form: ``map_concat(envelope, article)``.

    Requires ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` so the article's value
    replaces the envelope's for a shared key (explicit nulls included).
    """
    return F.map_concat(envelope, article)


BAR_RENAMES = dict(zip(BAR_FIELDS, BAR_COLUMNS))


def classify_payloads(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """add ``status`` = ok / rate_limited / unexpected."""
    p = F.col(payload_col)
    status = (F.when(p[DAILY_SERIES_FIELD].isNotNull(), F.lit(SERIES_OK))
               .when(p[RATE_LIMIT_FIELDS[0]].isNotNull() | p[RATE_LIMIT_FIELDS[1]].isNotNull(),
                     F.lit(RATE_LIMITED))
               .otherwise(F.lit(UNEXPECTED)))
    return payloads.withColumn("status", status)


def flatten_map(df: DataFrame, json_col: str, map_type: str, keep=(), key_name: str = "key",
                value_name: str = "value") -> DataFrame:
    """P13 (generic form): a JSON object column → one row per entry.

    The daily series is such a map (date → bar); ``normalize_bars`` applies
    the same ``explode`` and then renames the bar fields.
    """
    return df.select(*keep, F.explode(F.from_json(F.col(json_col), map_type))
                     .alias(key_name, value_name))


def normalize_bars(payloads: DataFrame, symbol_col: str = "symbol", payload_col: str = "payload",
                   fetched_at: Column | None = None, source: str = BARS_SOURCE,
                   asset_class: str = ASSET_CLASS) -> DataFrame:
    """F4 + P13 + P8: ok payloads → one flat record per (symbol, date), text kept."""
    ok = classify_payloads(payloads, payload_col).where(F.col("status") == SERIES_OK)
    rows = ok.select(F.col(symbol_col).alias("symbol"),
                     F.explode(F.col(payload_col)[DAILY_SERIES_FIELD]).alias("date", "bar"))
    fetched = fetched_at if fetched_at is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return rows.select(
        F.lit(source).alias("source"), F.lit(asset_class).alias("asset_class"), "symbol", "date",
        *[F.col("bar")[k].alias(v) for k, v in BAR_RENAMES.items()],
        fetched.alias("fetched_at"), keys.bar_key("symbol", "date").alias("dedup_key"))


def normalize_ticks(messages: DataFrame, text_col: str = "value",
                    fetched_at: Column | None = None, source: str = TICKS_SOURCE,
                    asset_class: str = ASSET_CLASS) -> DataFrame:
    """F2 + P14 + P12 + P10: relay messages (JSON text) → one record per trade tick.

    Non-trade messages (pings) are dropped, a message without ``data`` yields
    nothing, a tick without ``s`` is ``UNKNOWN`` and one without ``c`` gets
    ``[]``.  Text that is no number gives a null price or volume, never an
    error.  The key uses the numbers as the producer writes them.
    """
    msg = messages.select(F.from_json(F.col(text_col), S.TICK_MESSAGE).alias("m"))
    trades = msg.where(F.col("m.type") == F.lit(TRADE_TYPE))
    t = trades.select(F.explode(F.coalesce(F.col("m.data"), F.array())).alias("t"))
    sym = keys.symbol_or_unknown(F.col("t.s"))
    fetched = fetched_at if fetched_at is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return t.select(
        F.lit(source).alias("source"), F.lit(asset_class).alias("asset_class"), sym.alias("symbol"),
        F.col("t.p").try_cast("double").alias("price"), F.col("t.v").try_cast("double").alias("volume"),
        F.col("t.t").alias("timestamp_ms"),
        F.coalesce(F.col("t.c"), F.array().cast("array<string>")).alias("conditions"),
        fetched.alias("fetched_at"),
        keys.tick_key(sym, F.col("t.t"), keys.python_number("t.p"), keys.python_number("t.v"))
        .alias("dedup_key"))
