"""tidepool: a Spark-native market-data lakehouse.

Raw JSON landing → typed, deduplicated, partitioned Parquet (bronze) →
event-time anomaly detection (batch and Structured Streaming) →
first-seen alerting with expiry, plus clearly marked extensions
(signals, as-of joins, rollups, data quality, CDC).

Every operator is a plain ``DataFrame -> DataFrame`` function built on
Spark SQL expressions, so Catalyst prunes, pushes down and plans it.
"""

__version__ = "0.1.0"
