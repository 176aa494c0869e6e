"""Gold kept up to date by changes: only the groups that a change touches are computed again.

Three plain tables, each partitioned so that a change rewrites few files:

* ``order_facts`` (by order year) has every order and every order key with lines: the
  distinct order row with its ``copies``, and the summed revenue and the number of lines of its
  key.  Orders without lines, and lines without an order, wait there for their other half;
* ``revenue_by_order_date`` (by order year) and ``top_customers`` (by a hash of the
  customer) are the business tables.

A change set names orders that come or change, orders whose lines come or change (with all
their lines), and orders that go.  From the facts of these keys before and after the
change follow the touched dates and customers.  Their groups are aggregated anew from the
facts, so sums, distinct counts and first and last dates are exact whatever was changed or
removed; all other groups stay as they are, and so do the files of partitions without a
touched group.

The facts are narrow (one row for each order, seven columns).  A change scans their key and
customer columns once; only rows of changed keys and touched groups are shuffled, and daily
groups are looked for in their years only.  Small change sets are broadcast where Spark
measures them as small, large ones are merged.

The facts are written last: a run that dies before that leaves the facts as they were, and
the same change set applied again finds the same groups and computes them again.  One
writer at a time is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold
from strata.schemas import REVENUE_SUM
from strata.session import work_root
from strata.sinks import tables as T
from strata.sinks.writes import by_key, is_in, replace_keys, write_table

KEY = "o_orderkey"
#: Directories of the customer table.
CUSTOMER_PARTS = 64
#: Table -> the column it is partitioned by.
LAYOUT = {"order_facts": "order_year", "revenue_by_order_date": "order_year", "top_customers": "customer_part"}


@dataclass(frozen=True)
class Changes:
    """Clean-layer rows.  ``deleted`` (o_orderkey) go first, with their lines; then
    ``orders`` replace the rows of their keys, and ``lines`` all lines of their keys.  An
    order loses its lines, and stays, by being deleted and given again."""
    orders: DataFrame
    lines: DataFrame
    deleted: DataFrame


@dataclass(frozen=True)
class Applied:
    """Partition values that were rewritten, by table."""
    rewritten: dict[str, list]


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def joined_facts(copies: DataFrame, totals: DataFrame) -> DataFrame:
    """Every order row and every key with lines, whether the other side is there or not."""
    return copies.join(totals, KEY, "full_outer").select(
        KEY, "o_custkey", "o_orderdate", "copies", F.col("revenue").alias("line_revenue"), "line_count",
        F.year("o_orderdate").alias("order_year"))


def whole(facts: DataFrame) -> DataFrame:
    """The facts that an inner join of orders and lines has, as ``gold.order_facts`` does."""
    return facts.where("copies IS NOT NULL AND line_count IS NOT NULL").select(
        *gold.FACT_COLUMNS, (F.col("line_revenue") * F.col("copies")).cast(REVENUE_SUM).alias("revenue"),
        (F.col("line_count") * F.col("copies")).alias("line_count"))


def _customers(facts: DataFrame) -> DataFrame:
    part = F.pmod(F.xxhash64("customer_key"), F.lit(CUSTOMER_PARTS)).cast("int")
    return gold.top_customers(whole(facts)).withColumn("customer_part", part)


def build(spark: SparkSession, root: str, orders: DataFrame, lineitem: DataFrame) -> None:
    """Store the three tables from the whole clean layer."""
    write_table(joined_facts(gold.order_copies(orders), gold.line_totals(lineitem)),
                _path(root, "order_facts"), "order_year", rebalance=True)
    facts = spark.read.parquet(_path(root, "order_facts"))
    write_table(gold.revenue_by_order_date(whole(facts)), _path(root, "revenue_by_order_date"), "order_year", rebalance=True)
    write_table(_customers(facts), _path(root, "top_customers"), "customer_part", rebalance=True)


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A business table as it stands, with its own columns in order."""
    stored = spark.read.parquet(_path(root, table))
    if table == "top_customers":
        return stored.drop("customer_part")
    columns = stored.columns
    if table == "revenue_by_order_date":
        columns = ["order_date", "order_year", "order_month", "total_revenue", "line_count", "order_count"]
    return stored.select(columns)


class Scratch:
    """Tables in the shared scratch folder: what is read several times, and must stay what
    it was while the tables that it comes from are rewritten."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, work_root(spark, "maintenance")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        T.remove_own(self.spark, self.folder)


def _facts_after(old: DataFrame, copies: DataFrame, totals: DataFrame, gone: DataFrame) -> DataFrame:
    """The facts of the changed keys once the change is made: ``copies`` and ``totals`` of
    the orders and lines that come, after the keys that are ``gone``."""
    orders = old.where("copies IS NOT NULL").select(*gold.FACT_COLUMNS, "copies")
    orders = by_key(orders, gone.unionByName(copies.select(KEY)), KEY, "left_anti")
    before = old.where("line_count IS NOT NULL").groupBy(KEY).agg(
        F.first("line_revenue").alias("revenue"), F.first("line_count").alias("line_count"))
    before = by_key(before, gone.unionByName(totals.select(KEY)), KEY, "left_anti")
    return joined_facts(orders.unionByName(copies), before.unionByName(totals))


def apply(spark: SparkSession, root: str, changes: Changes) -> Applied:
    """Bring the three tables up to date with ``changes``, which are read once each."""
    scratch = Scratch(spark)
    copies = scratch.keep(gold.order_copies(changes.orders), "copies")
    totals = scratch.keep(gold.line_totals(changes.lines), "totals")
    gone = scratch.keep(changes.deleted.select(KEY).distinct(), "deleted")
    keys = scratch.keep(copies.select(KEY).unionByName(totals.select(KEY)).unionByName(gone)
                        .where(F.col(KEY).isNotNull()).distinct(), "changed-keys")
    facts = spark.read.parquet(_path(root, "order_facts"))
    old = scratch.keep(by_key(facts, keys, KEY, "left_semi", unique=True), "facts-before")
    new = scratch.keep(_facts_after(old, copies, totals, gone), "facts-after")
    touched = whole(old.unionByName(new))
    dates = scratch.keep(touched.select(
        F.col("o_orderdate").alias("order_date"), F.year("o_orderdate").alias("order_year")).distinct(), "touched-dates")
    customers = scratch.keep(touched.select(F.col("o_custkey").alias("customer_key")).distinct(), "touched-customers")

    after = by_key(facts, keys, KEY, "left_anti", unique=True).select(new.columns).unionByName(new)
    years = [r[0] for r in dates.select("order_year").distinct().collect()]
    of_dates = by_key(after.where(is_in(F.col("order_year"), years)),
                      dates.withColumnRenamed("order_date", "o_orderdate"), "o_orderdate", "left_semi", unique=True)
    of_customers = by_key(after, customers.withColumnRenamed("customer_key", "o_custkey"), "o_custkey", "left_semi", unique=True)
    daily = scratch.keep(gold.revenue_by_order_date(whole(of_dates)), "daily")
    spent = scratch.keep(_customers(of_customers), "customers")

    rewritten = {}
    for table, replaced, rows, key in (
            ("revenue_by_order_date", dates, daily, "order_date"), ("top_customers", customers, spent, "customer_key"),
            ("order_facts", keys, new, KEY)):
        rewritten[table] = replace_keys(spark, _path(root, table), replaced, rows, key, LAYOUT[table], True)
    scratch.remove()
    return Applied(rewritten)
