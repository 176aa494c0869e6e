"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given source tables (or data Spark derives from them)
in full; nothing is sampled, capped or filtered to keep a check cheap.  A
LIMIT appears only where the top-N report is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import analyst, checks
from strata.plans.sources import clean_tables, gold_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def silver_orders(spark, sf_dir):
    return clean_tables(spark, sf_dir)[0]


@query
def silver_lineitem(spark, sf_dir):
    return clean_tables(spark, sf_dir)[1]


@query
def revenue_by_order_date(spark, sf_dir):
    return gold_tables(spark, sf_dir)["revenue_by_order_date"]


@query
def top_customers(spark, sf_dir):
    return gold_tables(spark, sf_dir)["top_customers"]


@query
def total_revenue(spark, sf_dir):
    return analyst.total_revenue(revenue_by_order_date(spark, sf_dir))


@query
def yearly_revenue(spark, sf_dir):
    return analyst.yearly_revenue(revenue_by_order_date(spark, sf_dir))


@query
def yearly_revenue_sql(spark, sf_dir):
    view = "strata_daily_revenue"
    revenue_by_order_date(spark, sf_dir).createOrReplaceTempView(view)
    return analyst.yearly_revenue_sql(spark, view)


@query
def top_10_customers(spark, sf_dir):
    return analyst.top_n_customers(top_customers(spark, sf_dir), 10)


@query
def top_days_1996(spark, sf_dir):
    return analyst.top_days(revenue_by_order_date(spark, sf_dir), 1996, 10)


@query
def gold_preview(spark, sf_dir):
    return analyst.preview(revenue_by_order_date(spark, sf_dir), "order_date", 10)


@query
def gold_view(spark, sf_dir):
    analyst.register_views(spark, gold_tables(spark, sf_dir))
    return spark.sql("SELECT * FROM gold_revenue_by_order_date")


@query
def analyst_view(spark, sf_dir):
    analyst.register_views(spark, gold_tables(spark, sf_dir), persona="data_analyst")
    return spark.sql("SELECT * FROM gold_revenue_by_order_date")


@query
def qc_revenue_positive(spark, sf_dir):
    return checks.revenue_positive(revenue_by_order_date(spark, sf_dir))


@query
def qc_top_complete(spark, sf_dir):
    customers = top_customers(spark, sf_dir)
    report = analyst.top_n_customers(customers, 10)
    return checks.top_n_complete(customers, report, "total_revenue", "customer_key")


@query
def qc_top_sorted(spark, sf_dir):
    """The report as it is returned, and the same rows put in another order."""
    report = top_10_customers(spark, sf_dir)
    other = report.orderBy("customer_key")
    parts = [checks.sorted_desc(df, "total_revenue", "customer_key").select(F.lit(name).alias("report"), "*")
             for name, df in (("as_returned", report), ("by_customer", other))]
    return parts[0].unionByName(parts[1])


# Queries that ingest text or write tables register themselves on import.
from strata.plans import table_queries  # noqa: E402,F401
