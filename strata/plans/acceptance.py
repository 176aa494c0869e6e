"""The acceptance checklist of a run, evaluated on the tables it stored.

Every check reads what was written: rows are counted in the stored table, types are
those of its files, and partitioning is that of its directories.  Each is one
aggregate or a schema lookup; only its one-row result reaches the driver, and the
report is a small DataFrame of (check_name, passed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import analyst, checks
from strata.plans.layers import LayerJob

# The checklist, in the order it is reported.
CHECKS = (
    "bronze_rows_match_source",
    "silver_money_is_decimal_15_2",
    "silver_partitioned_by_year",
    "silver_no_null_keys",
    "gold_revenue_positive",
    "gold_top_customers_sorted",
)

MONEY = {"orders": ("o_totalprice",), "lineitem": ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
YEARS = {"orders": "order_year", "lineitem": "ship_year"}
KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def partitioned_by(df: DataFrame, column: str) -> bool:
    """Whether the stored rows lie in directories of ``column``'s values."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    inside = F.contains(F.col("_metadata.file_path"), F.concat(F.lit(f"/{column}="), value, F.lit("/")))
    found = df.select(inside.alias("inside")).agg(F.count(F.lit(1)).alias("n"), F.count_if("inside").alias("inside")).first()
    return found["n"] == found["inside"]


def acceptance(spark: SparkSession, job: LayerJob, source_counts: dict[str, int],
               money: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(check_name, passed) for a finished run.  ``source_counts`` are the
    row counts of the raw inputs (data lines or source-table rows), ``money`` the
    money columns that its sources carry (default: all; a missing one fails)."""
    counted = {t: job.read(spark, "bronze", t).count() for t in source_counts}
    silver = {t: job.read(spark, "silver", t) for t in YEARS}
    types = {t: dict(df.dtypes) for t, df in silver.items()}
    daily, top = (job.read(spark, "gold", t) for t in ("revenue_by_order_date", "top_customers"))
    report = analyst.top_n_customers(top, 10)
    passed = (
        counted == source_counts,
        all(types[t].get(c) == "decimal(15,2)" for t, cs in (money or MONEY).items() for c in cs),
        all(partitioned_by(df, YEARS[t]) for t, df in silver.items()),
        all(checks.null_keys(df, KEYS[t]).first()["null_keys"] == 0 for t, df in silver.items()),
        checks.revenue_positive(daily).first()["non_positive"] == 0,
        checks.sorted_desc(report, "total_revenue", "customer_key").first()["out_of_order"] == 0
        and checks.top_n_complete(top, report, "total_revenue", "customer_key").first()["missed"] == 0,
    )
    return spark.createDataFrame(list(zip(CHECKS, passed)), "check_name string, passed boolean")


def source_counts(spark: SparkSession, sf_dir: str, tables=("orders", "lineitem")
                  ) -> dict[str, int]:
    """Row counts of the source Parquet tables (one aggregate each)."""
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
            .agg(F.count(F.lit(1))).first()[0] for t in tables}
