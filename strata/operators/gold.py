"""Business layer: daily revenue and customer spend.

Plan shape:

1. ``line_totals``: lineitem aggregated per order key.  Partial aggregation
   runs map-side, so the only lineitem shuffle carries at most one row per
   (map task, order) instead of every line; a key holding a third of all lines
   collapses before it is shuffled.
2. ``order_copies``: orders reduced to the distinct rows of just the columns
   that the query needs, with a ``copies`` count, again with map-side partial
   aggregation.  In clean data every count is 1; when one key is copied across a
   large share of the table, the copies collapse before any exchange, so no join
   or aggregate task later receives the hot key's rows one by one.
3. ``order_facts``: the distinct order rows joined 1:1 to the per-order totals
   (sort-merge join on order key; AQE turns it into a broadcast join when it
   measures the orders side small at runtime).  Revenue and line count are
   weighted by ``copies``: each copy of an order joins every one of its lines.
4. Daily and customer aggregates from the facts.  Distinct orders are counted
   in two levels: (group key, order key) first, which the join's order-key
   partitioning satisfies without an exchange, then per group with a map-side
   partial aggregate, so a hot date or customer never lands in one task
   unreduced.  Year and month follow from the date after the last exchange.

The result equals joining every line and aggregating with a distinct count,
including orders that appear more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.schemas import REVENUE_SUM

DATE_FACTS = ("o_orderkey", "o_orderdate")
FACT_COLUMNS = ("o_orderkey", "o_custkey", "o_orderdate")


def line_totals(lineitem: DataFrame) -> DataFrame:
    """Per order key: summed revenue and number of lines."""
    return (
        lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("revenue").alias("revenue"),
             F.count("l_orderkey").alias("line_count"))
    )


def order_copies(orders: DataFrame, columns=FACT_COLUMNS) -> DataFrame:
    """Distinct order rows (the columns needed) with how often each occurs."""
    return orders.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))


def order_facts(orders: DataFrame, lineitem: DataFrame, columns=FACT_COLUMNS) -> DataFrame:
    """One row per distinct order row with at least one line (inner join),
    revenue and line count weighted by the row's copies."""
    joined = order_copies(orders, columns).join(line_totals(lineitem), "o_orderkey", "inner")
    return joined.select(
        *columns,
        (F.col("revenue") * F.col("copies")).cast(REVENUE_SUM).alias("revenue"),
        (F.col("line_count") * F.col("copies")).alias("line_count"))


def revenue_by_order_date(facts: DataFrame) -> DataFrame:
    """order_date, order_year, order_month, total_revenue, line_count, order_count."""
    per_order = (
        facts.groupBy("o_orderdate", "o_orderkey")
        .agg(F.sum("revenue").alias("revenue"), F.sum("line_count").alias("line_count"))
    )
    daily = per_order.groupBy("o_orderdate").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("line_count").alias("line_count"),
        F.count("o_orderkey").alias("order_count"))
    date = F.col("o_orderdate")
    return daily.select(
        date.alias("order_date"), F.year(date).alias("order_year"), F.month(date).alias("order_month"),
        "total_revenue", "line_count", "order_count")


def top_customers(facts: DataFrame) -> DataFrame:
    """Every customer: total_revenue, order_count, first/last order date.

    "Top N" is applied by the reader (``analyst.top_n_customers``); the table
    holds all customers and its physical order is not a contract.
    """
    per_order = (
        facts.groupBy("o_custkey", "o_orderkey")
        .agg(F.sum("revenue").alias("revenue"),
             F.min("o_orderdate").alias("first_date"),
             F.max("o_orderdate").alias("last_date"))
    )
    return (
        per_order.groupBy(F.col("o_custkey").alias("customer_key"))
        .agg(F.sum("revenue").alias("total_revenue"),
             F.count("o_orderkey").alias("order_count"),
             F.min("first_date").alias("first_order_date"),
             F.max("last_date").alias("last_order_date"))
    )


def build_gold(orders: DataFrame, lineitem: DataFrame) -> dict[str, DataFrame]:
    """Both business tables, each from facts of its own columns.  (The layer job
    stores the wider facts once and reads both from there.)"""
    return {
        "revenue_by_order_date": revenue_by_order_date(order_facts(orders, lineitem, DATE_FACTS)),
        "top_customers": top_customers(order_facts(orders, lineitem)),
    }
