"""Columnar and catalog sources.

Parquet sources are read by path so that the scan carries column pruning,
pushed filters and (for partitioned tables) partition pruning.  Object-store
URIs (s3a://, abfss://, ...) are plain paths to the Hadoop file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.schemas import SOURCE_TABLES


def read_parquet_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """``<base>/<table>.parquet`` (file or directory)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{table}.parquet")


def read_parquet_sources(spark: SparkSession, base: str, tables=SOURCE_TABLES
                         ) -> dict[str, DataFrame]:
    return {t: read_parquet_table(spark, base, t) for t in tables}


def read_catalog_table(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """``layer.table`` from the session catalog."""
    return spark.table(f"{layer}.{table}")
