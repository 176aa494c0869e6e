"""Typed inputs built from a directory of source Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators import gold, silver
from strata.sources.tables import read_parquet_table


def clean_tables(spark: SparkSession, sf_dir: str, audit: bool = False
                 ) -> tuple[DataFrame, DataFrame]:
    """Clean orders and lineitem straight from the source Parquet (lazy)."""
    orders = silver.clean_orders(read_parquet_table(spark, sf_dir, "orders"), audit=audit)
    lineitem = silver.clean_lineitem(read_parquet_table(spark, sf_dir, "lineitem"), audit=audit)
    return orders, lineitem


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders, lineitem = clean_tables(spark, sf_dir)
    return gold.build_gold(orders, lineitem)
