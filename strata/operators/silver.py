"""Clean layer: exact types, derived columns, audit column, null-key gate.

Map-only work (no shuffle): each function is a projection plus a filter that
Catalyst fuses into the scan's whole-stage code, with ``IsNotNull(key)``
pushed into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import typed
from strata.functions.measures import revenue
from strata.schemas import AUDIT_COLUMN, DATE_COLUMNS, KEY_COLUMNS, MONEY_COLUMNS


def _typed(df: DataFrame, table: str) -> DataFrame:
    return df.withColumns(typed(df, MONEY_COLUMNS[table], DATE_COLUMNS[table]))


def key_gate(df: DataFrame, table: str) -> DataFrame:
    """Drop rows whose key is NULL (declared non-null, not enforced on read)."""
    return df.filter(F.col(KEY_COLUMNS[table]).isNotNull())


def clean_orders(df: DataFrame, audit: bool = True) -> DataFrame:
    """orders -> decimal price, date, order_year, order_month (+ _ingested_at).

    Typing and deriving are two steps so year/month see the *typed* date.
    """
    out = _typed(df, "orders")
    derived = {
        "order_year": F.year("o_orderdate"),
        "order_month": F.month("o_orderdate"),
    }
    if audit:
        derived[AUDIT_COLUMN] = F.current_timestamp()
    return key_gate(out.withColumns(derived), "orders")


def clean_lineitem(df: DataFrame, audit: bool = True) -> DataFrame:
    """lineitem -> decimal money, dates, ship_year, revenue (+ _ingested_at)."""
    out = _typed(df, "lineitem")
    derived = {
        "ship_year": F.year("l_shipdate"),
        "revenue": revenue(F.col("l_extendedprice"), F.col("l_discount")),
    }
    if audit:
        derived[AUDIT_COLUMN] = F.current_timestamp()
    return key_gate(out.withColumns(derived), "lineitem")


CLEANERS = {"orders": clean_orders, "lineitem": clean_lineitem}


def clean(df: DataFrame, table: str, audit: bool = True) -> DataFrame:
    return CLEANERS[table](df, audit=audit)


def key_gate_counts(raw: DataFrame, table: str) -> DataFrame:
    """Rows before the gate, kept, and dropped — one scan, one aggregate."""
    key = F.col(KEY_COLUMNS[table])
    return raw.agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("rows_in"),
        F.count(key).alias("rows_kept"),
        F.count_if(key.isNull()).alias("rows_dropped"),
    )
