"""Paths of another store than the local one: everything goes through Spark's readers and
the Hadoop file system of the path, here a mounted view of local folders."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans import maintenance
from strata.plans.layers import LayerJob
from strata.plans.registry import QUERIES
from strata.plans.sources import clean_tables
from strata.sinks import clustered, upkeep
from strata.sinks import tables as T
from strata.sinks.writes import upsert_partitions, write_table


@pytest.fixture()
def store(spark, tmp_path):
    """(uri of the test tables, uri of an empty folder, that folder)."""
    name, out = "strata" + tmp_path.name.replace("_", "-").replace("[", "").replace("]", "").lower(), tmp_path / "out"
    out.mkdir()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(f"fs.viewfs.mounttable.{name}.link./data", f"file://{SF_SMALL}")
    conf.set(f"fs.viewfs.mounttable.{name}.link./out", f"file://{out}")
    return f"viewfs://{name}/data", f"viewfs://{name}/out", str(out)


def _rows(df):
    columns = sorted(df.columns)
    return sorted(map(repr, df.select(columns).collect()))


@pytest.mark.parametrize("name", [
    "silver_orders", "revenue_by_order_date", "top_10_customers", "bronze_lineitem", "silver_dirty_casts", "upsert_orders_by_partition",
    "row_counts", "raw_rejected", "mixed_schema_files"])
def test_queries_read_any_store(spark, store, name):
    assert _rows(QUERIES[name](spark, store[0])) == _rows(QUERIES[name](spark, SF_SMALL))


def test_the_job_and_upkeep_write_to_any_store(spark, store):
    source, root, folder = store
    job = LayerJob(source=source, root=f"{root}/wh").run(spark)
    assert T.tables_under(spark, f"{root}/wh") and job.read(spark, "gold", "top_customers").count() > 0
    assert T.current_path(spark, f"{root}/wh", "silver", "orders") == job.paths["silver", "orders"]
    assert all(r["same_rows"] for r in upkeep.copy_tables(spark, f"{root}/wh", f"{root}/copy").collect())

    orders = clean_tables(spark, source)[0]
    path = f"{root}/orders"
    write_table(orders.repartition(4), path, "order_year")
    upsert_partitions(spark, path, orders.where("order_year = 1995").withColumn("o_orderstatus", F.lit("U")), "o_orderkey", "order_year")
    before = upkeep.table_files(spark, path, "order_year").count()
    assert upkeep.compact(spark, path, "order_year") and upkeep.table_files(spark, path, "order_year").count() < before
    assert spark.read.parquet(path).count() == orders.count()
    assert not [d for d in os.listdir(f"{folder}/orders") if d.startswith("_comp")]

    customers = job.read(spark, "gold", "top_customers")
    by = [("total_revenue", "desc"), ("customer_key", "asc")]
    clustered.write_clustered(customers, f"{root}/customers", by, 4)
    want = customers.orderBy(F.desc("total_revenue"), "customer_key").limit(3)
    assert clustered.first_rows(spark, f"{root}/customers", by, 3).collect() == want.collect()

    live, lines = f"{root}/live", clean_tables(spark, source)[1]
    maintenance.build(spark, live, orders, lines)
    gone = orders.where("o_orderkey % 3 = 0").select("o_orderkey")
    maintenance.apply(spark, live, maintenance.Changes(orders.limit(0), lines.limit(0), gone))
    left = maintenance.read(spark, live, "revenue_by_order_date").agg(F.sum("order_count")).first()[0]
    assert left == orders.where("o_orderkey % 3 <> 0").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").count()
    job.drop_tables(spark, with_data=True)
    assert not any(os.path.exists(p.replace(root, folder)) for p in job.paths.values())
