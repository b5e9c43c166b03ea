"""Fixed values.

These values must equal the ones the landed data was produced with (or the
configuration the lake mirrors) for keys, paths and results to agree.  They
are stated here once, plainly, and imported everywhere else.
"""

# ---------------------------------------------------------------- fixed values
# Record keys: first 16 hex digits of SHA-256 over "|"-joined parts; an
# article without url is keyed with '', one without datetime with 0; a
# record without symbol is published under UNKNOWN.
KEY_SEPARATOR = "|"
KEY_HEX_DIGITS = 16
MISSING_URL = ""
MISSING_DATETIME = "0"
UNKNOWN_SYMBOL = "UNKNOWN"

# Envelope values written by the three producers.
NEWS_SOURCE = "finnhub"
BARS_SOURCE = "alpha_vantage"
TICKS_SOURCE = "finnhub_ws"
ASSET_CLASS = "equity"

# Daily-series payload: the series field, the rate-limit fields, the bar fields.
DAILY_SERIES_FIELD = "Time Series (Daily)"
RATE_LIMIT_FIELDS = ("Note", "Information")
BAR_FIELDS = ("1. open", "2. high", "3. low", "4. close", "5. volume")
BAR_COLUMNS = ("open", "high", "low", "close", "volume")

# Relay messages: only this message type carries ticks.
TRADE_TYPE = "trade"

# Detector: tumbling window, threshold (count >= threshold), lateness bound.
WINDOW = "5 minutes"
THRESHOLD = 3
WATERMARK_DELAY = "30 seconds"

# Alerter: a batch's records and waiting time, tries of a record that fails, key
# expiry in days; subject length limit.
ALERT_BATCH_RECORDS = 100
ALERT_BATCH_SECONDS = 30
ALERT_TRIES = 5
ALERT_TTL_DAYS = 30
ALERT_SUBJECT_MAX = 99

# Records per publish call on the stream.
PUBLISH_CHUNK = 500

# Partition projection domain of the raw tables and the news location template.
# All months, days and hours are in it.
PROJECTION_YEARS = (2024, 2030)
NEWS_LOCATION_TEMPLATE = ("source=finnhub/asset_class=equity/symbol={symbol}/year={year}"
                          "/month={month}/day={day}/hour={hour}/")
