"""Declared schemas of the raw, clean and business tables.

Raw text is never schema-inferred: each source table has a declared
``StructType``.  Money and dates are read as text on purpose and typed in the
clean layer, so that a malformed value becomes NULL instead of failing the
scan.  Keys are declared non-null but Spark reads file schemas as nullable;
the clean layer's key gate enforces it.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType, DateType, DecimalType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)

MONEY = DecimalType(15, 2)
REVENUE = DecimalType(32, 4)
REVENUE_SUM = DecimalType(38, 4)

# Raw column names, file order and declared types of the two
# TPC-H source tables (text ingest binds columns by position).
ORDERS_RAW = StructType([
    StructField("o_orderkey", LongType(), False),
    StructField("o_custkey", LongType(), False),
    StructField("o_orderstatus", StringType(), True),
    StructField("o_totalprice", StringType(), True),
    StructField("o_orderdate", StringType(), True),
    StructField("o_orderpriority", StringType(), True),
    StructField("o_clerk", StringType(), True),
    StructField("o_shippriority", IntegerType(), True),
    StructField("o_comment", StringType(), True),
])

LINEITEM_RAW = StructType([
    StructField("l_orderkey", LongType(), False),
    StructField("l_partkey", LongType(), True),
    StructField("l_suppkey", LongType(), True),
    StructField("l_linenumber", IntegerType(), False),
    StructField("l_quantity", StringType(), True),
    StructField("l_extendedprice", StringType(), True),
    StructField("l_discount", StringType(), True),
    StructField("l_tax", StringType(), True),
    StructField("l_returnflag", StringType(), True),
    StructField("l_linestatus", StringType(), True),
    StructField("l_shipdate", StringType(), True),
    StructField("l_commitdate", StringType(), True),
    StructField("l_receiptdate", StringType(), True),
    StructField("l_shipinstruct", StringType(), True),
    StructField("l_shipmode", StringType(), True),
    StructField("l_comment", StringType(), True),
])

RAW_SCHEMAS: dict[str, StructType] = {"orders": ORDERS_RAW, "lineitem": LINEITEM_RAW}
SOURCE_TABLES = ("orders", "lineitem")

# Which raw text columns the clean layer types, and how.
MONEY_COLUMNS = {
    "orders": ("o_totalprice",),
    "lineitem": ("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
}
DATE_COLUMNS = {
    "orders": ("o_orderdate",),
    "lineitem": ("l_shipdate", "l_commitdate", "l_receiptdate"),
}
KEY_COLUMNS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
PARTITION_COLUMNS = {
    ("silver", "orders"): "order_year",
    ("silver", "lineitem"): "ship_year",
    ("gold", "revenue_by_order_date"): "order_year",
}
DATE_FORMAT = "yyyy-MM-dd"

# Business-layer schemas (asserted by tests; total_revenue keeps scale 4).
REVENUE_BY_ORDER_DATE = StructType([
    StructField("order_date", DateType(), True),
    StructField("order_year", IntegerType(), True),
    StructField("order_month", IntegerType(), True),
    StructField("total_revenue", REVENUE_SUM, True),
    StructField("line_count", LongType(), False),
    StructField("order_count", LongType(), False),
])

TOP_CUSTOMERS = StructType([
    StructField("customer_key", LongType(), True),
    StructField("total_revenue", REVENUE_SUM, True),
    StructField("order_count", LongType(), False),
    StructField("first_order_date", DateType(), True),
    StructField("last_order_date", DateType(), True),
])

AUDIT_COLUMN = "_ingested_at"
AUDIT_TYPE: DataType = TimestampType()


def raw_schema(table: str, columns: list[str] | tuple[str, ...] | None = None) -> StructType:
    """Declared raw schema of ``table``; optionally only the leading
    ``columns`` (a file that carries a prefix of the TPC-H columns)."""
    full = RAW_SCHEMAS[table]
    if columns is None:
        return full
    wanted = [c.lower() for c in columns]
    names = [f.name for f in full.fields]
    if names[: len(wanted)] != wanted:
        raise ValueError(f"{table}: columns {wanted} are not a prefix of {names}")
    return StructType(full.fields[: len(wanted)])
