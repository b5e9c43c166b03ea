"""Zones and ad-hoc SQL (§1.1 zones, E5).

Each zone (raw, bronze, silver, gold) is a catalog database with its own
base path; tables are registered over their folders so ``spark.sql`` sees
them with partition pruning intact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ZONES = ("raw", "bronze", "silver", "gold")


def create_zones(spark: SparkSession, base_path: str, prefix: str = "lake") -> dict[str, str]:
    """``CREATE DATABASE IF NOT EXISTS <prefix>_<zone> LOCATION <base>/<zone>``."""
    out = {}
    for z in ZONES:
        name = f"{prefix}_{z}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{base_path.rstrip('/')}/{z}'")
        out[z] = name
    return out


def register_parquet_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register an existing (partitioned) Parquet folder as a catalog table."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")  # pick up partition folders
    return spark.table(name)


def register_views(spark: SparkSession, sf_dir: str, tables) -> None:
    """Temp views over Parquet tables in a folder, for ``spark.sql`` (E5)."""
    for t in tables:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(t)
