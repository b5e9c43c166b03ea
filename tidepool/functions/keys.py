"""Record keys and alert text as Column expressions.

Keys are the first 16 hex digits of SHA-256 over ``|``-joined parts, with
each part rendered the way a Python f-string renders it (null → ``None``),
so keys computed here equal keys computed by the producers.  ``concat_ws``
is avoided on purpose: it *skips* nulls and would shift the parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import (ALERT_SUBJECT_MAX, KEY_HEX_DIGITS, KEY_SEPARATOR, MISSING_DATETIME,
                     MISSING_URL, UNKNOWN_SYMBOL)
from .util import as_col, py_text


def short_sha256(*parts) -> Column:
    """First 16 hex digits of SHA-256 of the ``|``-joined parts."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(KEY_SEPARATOR))
        pieces.append(p if isinstance(p, Column) else py_text(p))
    return F.substring(F.sha2(F.concat(*pieces), 256), 1, KEY_HEX_DIGITS)


def bar_key(symbol, date) -> Column:
    """Key of a daily bar, ``sha256(symbol|date)[:16]``."""
    return short_sha256(py_text(symbol), py_text(date))


def news_key(symbol, datetime, url) -> Column:
    """Key of an article, ``sha256(symbol|datetime|url)[:16]``.

    A missing ``datetime`` is keyed as ``0`` and a missing ``url`` as ``''``.
    """
    return short_sha256(
        py_text(symbol),
        F.coalesce(as_col(datetime).cast("string"), F.lit(MISSING_DATETIME)),
        F.coalesce(as_col(url).cast("string"), F.lit(MISSING_URL)))


def _taken_apart(plain: Column) -> Column:
    """Digits, exponent and sign of a double's scientific text, each computed once."""
    mantissa = F.rtrim(F.translate(F.substring_index(plain, "E", 1), "-.", ""), F.lit("0"))
    return F.struct(F.when(mantissa == "", "0").otherwise(mantissa).alias("digits"),
                    F.substring_index(plain, "E", -1).try_cast("int").alias("exp"),
                    F.when(plain.startswith("-"), "-").otherwise("").alias("sign"))


def _laid_out(number: Column) -> Column:
    """The text that the producer would print, from the parts."""
    digits, exp = number["digits"], number["exp"]
    rest = F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise("")
    power = F.abs(exp).cast("string")
    scientific = F.concat(F.substr(digits, F.lit(1), F.lit(1)), rest, F.lit("e"),
                          F.when(exp < 0, "-").otherwise("+"),
                          F.lpad(power, F.greatest(F.length(power), F.lit(2)), "0"))
    return F.concat(number["sign"], scientific)


def python_number(text) -> Column:
    """A JSON number (as text) the way the producer prints it: integers as they
    are; other numbers in plain digits from 1e-4 up to 1e16, else as ``1.5e-05``.

    Spark prints a double in plain digits from 1e-3 up to 1e7 only.  What the
    producer prints plainly beyond that goes by way of a decimal; the rest has its
    scientific form taken apart once and laid out again (in two ``transform``
    steps, which bind the parts).  Text that is no
    number stays as it is, null stays null.  (The digits are Java's: the smallest
    denormal numbers show one more digit than the producer prints.)
    """
    t = as_col(text)
    d = t.try_cast("double")
    plain = d.cast("string")
    # 17 digits at most, none below the 21st decimal: exact, and trailing zeros are filling
    laid = F.rtrim(d.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    laid = F.when(laid.endswith("."), F.concat(laid, F.lit("0"))).otherwise(laid)
    far = F.transform(F.array(plain), lambda p: F.transform(F.array(_taken_apart(p)), _laid_out)[0])[0]
    number = (F.when(~plain.contains("E"), plain).when((F.abs(d) >= 1e-4) & (F.abs(d) < 1e16), laid)
               .otherwise(far))
    return F.when(t.rlike(r"^-?[0-9]+$"), t).otherwise(F.coalesce(number, t))


def tick_key(symbol, timestamp_ms, price_text, volume_text) -> Column:
    """P10: key of a tick, ``sha256(symbol|t|p|v)[:16]``.

    Price and volume are passed as ``python_number`` gives them.
    """
    return short_sha256(py_text(symbol), py_text(timestamp_ms), py_text(price_text),
                        py_text(volume_text))


# Alert key timestamp text; Python's str(datetime) without fraction.
ALERT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def alert_key(symbol, window_start, window_start_is_text: bool = False) -> Column:
    """Alert key ``symbol|window_start``.

    A timestamp is rendered ``yyyy-MM-dd HH:mm:ss``; text (as decoded from
    an anomaly record) is used as it is.
    """
    ws = as_col(window_start)
    ws_text = ws if window_start_is_text else F.date_format(ws, ALERT_TS_FORMAT)
    return F.concat(py_text(symbol), F.lit(KEY_SEPARATOR), F.coalesce(ws_text, F.lit("None")))


# Our product prefix for alert subjects.
ALERT_SUBJECT_PREFIX = "[tidepool] Anomaly: "


def alert_subject(symbol, event_count, prefix: str = ALERT_SUBJECT_PREFIX) -> Column:
    """``<prefix><symbol> - <count> events`` cut to 99 characters."""
    text = F.concat(F.lit(prefix), py_text(symbol), F.lit(" - "), py_text(event_count),
                    F.lit(" events"))
    return F.substring(text, 1, ALERT_SUBJECT_MAX)


def alert_body(*cols) -> Column:
    """The anomaly as indented JSON (timestamps become text)."""
    return F.to_json(F.struct(*[as_col(c) for c in cols]),
                     {"pretty": "true", "ignoreNullFields": "false"})


def parse_ticker_list(text: str) -> list[str]:
    """``"aapl, msft"`` → ``["AAPL", "MSFT"]``; the text is configuration."""
    return [t.strip().upper() for t in text.split(",")]


def decode_base64_json(c, schema) -> Column:
    """base64 text → JSON → struct; undecodable input gives null."""
    raw = F.try_to_binary(as_col(c), F.lit("base64")).cast("string")
    return F.from_json(raw, schema)


def symbol_or_unknown(c) -> Column:
    """Partition key of a record, ``UNKNOWN`` when it has no symbol."""
    return F.coalesce(as_col(c), F.lit(UNKNOWN_SYMBOL))
