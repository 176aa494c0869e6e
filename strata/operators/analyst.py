"""Analyst queries over the business tables, and the views they read.

Top-N reads always carry an explicit order with a key tie-break, so Spark
plans them as ``TakeOrderedAndProject`` (a per-task top-N followed by a
merge of N rows per task) rather than a global sort; a LIMIT that relied on
the stored order would only be right by accident.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.catalog import publish_view

# Columns a restricted analyst may read per business table.
PERSONA_COLUMNS = {
    "data_analyst": {"revenue_by_order_date": ("order_year", "total_revenue")},
}


def yearly_revenue(daily: DataFrame) -> DataFrame:
    """Roll-up of daily revenue: sum of sums and of order counts per year."""
    return (
        daily.groupBy("order_year")
        .agg(F.sum("total_revenue").alias("yearly_revenue"),
             F.sum("order_count").alias("yearly_orders"))
        .orderBy("order_year")
    )


def total_revenue(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("total_revenue").alias("total_revenue"))


def top_n_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    return (
        customers.orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("customer_key"))
        .limit(n)
        .select("customer_key", "total_revenue", "order_count")
    )


def top_days(daily: DataFrame, year: int, n: int = 10) -> DataFrame:
    """Best days of one year; the year filter prunes partitions when
    ``daily`` is the stored, year-partitioned table."""
    return (
        daily.where(F.col("order_year") == F.lit(year))
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("order_date"))
        .limit(n)
        .select("order_date", "total_revenue", "order_count")
    )


def preview(df: DataFrame, order_by: str, n: int = 10) -> DataFrame:
    """``SELECT * .. LIMIT n`` made deterministic: the first ``n`` rows by
    ``order_by`` (a per-task top-N, not a sort of the table)."""
    return df.orderBy(F.asc_nulls_last(order_by)).limit(n)


def restricted(df: DataFrame, persona: str, table: str) -> DataFrame:
    """Projection of the columns ``persona`` may see (column-level grant
    re-expressed as a view; enforcement itself is outside Spark).  What isn't
    listed is denied: an unknown persona, or a table it has no columns of, raises
    ``PermissionError``."""
    columns = PERSONA_COLUMNS.get(persona, {}).get(table)
    if not columns:
        raise PermissionError(f"{persona} may not read {table}")
    return df.select(*columns)


def register_views(spark: SparkSession, tables: dict[str, DataFrame],
                   persona: str | None = None) -> list[str]:
    """Temp view per business table (``gold_<table>``); for a ``persona`` only the
    tables it is listed for, with the columns listed."""
    if persona is not None:
        if persona not in PERSONA_COLUMNS:
            raise PermissionError(f"{persona} may read nothing")
        tables = {t: df for t, df in tables.items() if t in PERSONA_COLUMNS[persona]}
    names = []
    for table, df in tables.items():
        name = f"gold_{table}"
        (restricted(df, persona, table) if persona else df).createOrReplaceTempView(name)
        names.append(name)
    return names


def publish_persona_views(spark: SparkSession, persona: str, layer: str, views: str) -> list[str]:
    """Persistent views ``<views>.<table>`` of what ``persona`` may read in ``layer``:
    kept in the catalog for every later session, and following their tables when
    these are re-pointed.  The database ``views`` must exist."""
    if persona not in PERSONA_COLUMNS:
        raise PermissionError(f"{persona} may read nothing")
    names = []
    for table, columns in PERSONA_COLUMNS[persona].items():
        name = f"{views}.{table}"
        publish_view(spark, name, f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM `{layer}`.`{table}`")
        names.append(name)
    return names


YEARLY_REVENUE_SQL = """
FROM {table}
|> AGGREGATE sum(total_revenue) AS yearly_revenue, sum(order_count) AS yearly_orders GROUP BY order_year
|> ORDER BY order_year ASC NULLS FIRST
"""


def yearly_revenue_sql(spark: SparkSession, table: str) -> DataFrame:
    """The analyst's SQL-text form of ``yearly_revenue`` over a table or view."""
    return spark.sql(YEARLY_REVENUE_SQL.format(table=table))
