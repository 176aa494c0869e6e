"""Stored order, files of mixed schemas, rejected lines, co-located joins."""

from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from conftest import DAILY, SF_SMALL, plain_sql
from strata.operators import gold
from strata.plans.sources import clean_tables, gold_tables
from strata.sinks import catalog
from strata.sinks.clustered import first_rows, ranges, write_clustered
from strata.sinks.colocated import frequent_keys, store_colocated
from strata.sinks.writes import write_table
from strata.sources.bound import read_bound, refuse_unbound
from strata.sources.rejects import split_raw


def _rows(df):
    return sorted(map(repr, df.collect()))


# -- stored order --------------------------------------------------------------

def _statistics(path, column):
    """(low, high) of each file, by its Parquet statistics, in order of the names."""
    out = []
    for f in sorted(glob.glob(f"{path}/*.parquet")):
        meta = pq.ParquetFile(f).metadata
        i = meta.schema.to_arrow_schema().names.index(column)
        own = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
        if own:
            out.append((min(s.min for s in own), max(s.max for s in own)))
    return out


def _scanned(df):
    """Rows that the scan hands on, after the files' statistics were used."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_files_hold_ranges(spark, tmp_path):
    daily = gold_tables(spark, SF_SMALL)["revenue_by_order_date"]
    path = str(tmp_path / "daily")
    write_clustered(daily, path, [("order_date", "asc")], 6)
    spans = _statistics(path, "order_date")
    assert len(spans) >= 5 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert _rows(spark.read.parquet(path)) == _rows(daily)
    for f in glob.glob(f"{path}/*.parquet"):
        days = pq.read_table(f).column("order_date").to_pylist()
        assert days == sorted(days)
    one = spark.read.option("spark.sql.parquet.filterPushdown", "true").parquet(path).where(F.col("order_date") == F.lit(spans[2][0]))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert 0 < _scanned(one) < daily.count() / 3          # row groups outside the range are skipped
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_first_rows_open_the_first_files(spark, tmp_path):
    customers = gold_tables(spark, SF_SMALL)["top_customers"]
    path, by = str(tmp_path / "a table"), [("total_revenue", "desc"), ("customer_key", "asc")]
    write_clustered(customers, path, by, 5)
    want = [tuple(r) for r in customers.orderBy(F.desc("total_revenue"), "customer_key").limit(12).collect()]
    got = first_rows(spark, path, by, 12)
    assert [tuple(r) for r in got.collect()] == want
    assert len(got.inputFiles()) < len(glob.glob(f"{path}/*.parquet"))
    assert first_rows(spark, path, by, 10**6).count() == customers.count()
    found = [(r["low"], r["high"]) for r in ranges(spark, path, "total_revenue").collect()]
    assert all(a[0] >= b[1] for a, b in zip(found, found[1:]))
    with pytest.raises(ValueError):
        write_clustered(customers, path, [("customer_key", "up")], 3)


def test_a_frequent_value_is_split(spark, tmp_path):
    table = spark.range(9000).select(F.when(F.col("id") < 4000, 7).otherwise(F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    path = str(tmp_path / "t")
    write_clustered(table, path, [("k", "asc")], 9)
    sizes = [r["row_count"] for r in ranges(spark, path, "k").collect()]
    assert max(sizes) < 2500 and sum(sizes) == 9000           # 4090 rows of one value in several files
    spans = _statistics(path, "k")
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


# -- mixed schemas --------------------------------------------------------------

NEW = StructType([StructField("id", LongType()), StructField("n", LongType()), StructField("label", StringType()), StructField("note", StringType())])


def test_old_and_new_files_are_one_table(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(4).select(F.col("id").cast("int").alias("id"), (F.col("id") * 2).cast("int").alias("n"), F.lit("o").alias("name"))
    new = spark.range(10, 13).select("id", (F.col("id") * 3).alias("n"), F.lit("l").alias("label"), F.lit("x").alias("note"))
    write_table(old, path)
    write_table(new, path, mode="append")
    got = read_bound(spark, path, NEW, former={"label": ["name"]})
    assert got.schema == NEW
    assert sorted(map(tuple, got.collect())) == [(i, 2 * i, "o", None) for i in range(4)] + [(i, 3 * i, "l", "x") for i in range(10, 13)]
    assert got.where("note IS NULL AND n >= 4").count() == 2
    plan = got.select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<id:bigint>" in plan
    refuse_unbound(NEW, old.schema, {"label": ["name"]})
    refuse_unbound(NEW, new.schema)


def test_narrowing_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    narrow = StructType([StructField("id", IntegerType())])
    with pytest.raises(ValueError, match="declared as int"):
        refuse_unbound(narrow, spark.read.parquet(path).schema)
    with pytest.raises(Exception):
        read_bound(spark, path, narrow).collect()
    with pytest.raises(ValueError, match="two columns"):
        read_bound(spark, path, NEW, former={"label": ["note"]})


# -- rejected lines --------------------------------------------------------------

LINES = ["1|10|F|12.50|1996-01-02|1-URGENT|", "x2|10|F|12.50|1996-01-02|1-URGENT|", "3|10|F|n/a|1996-1-2|p|", "|4|F|||", "5|", "6|10|F|1.005|1996-01-02|p|more|",
         "7|10|F|12345678901234.00|1996-01-02|p|", "8|y|F| 1.5 |1996-02-30|p", "9999999999999999999999|1|F|1|1996-01-01|p|", "", "   "]


def test_every_line_is_on_one_side(spark, tmp_path):
    path = tmp_path / "orders.tbl"
    path.write_text("\n".join(LINES) + "\n")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    accepted, rejected = split_raw(spark, str(path), "orders", str(tmp_path / "out"), header=False, columns=columns)
    assert {r["line"]: r["reasons"] for r in rejected.collect()} == {
        LINES[1]: ["bad_key"], LINES[2]: ["bad_money", "bad_date"], LINES[3]: ["bad_key"], LINES[6]: ["bad_money"],
        LINES[7]: ["bad_date"], LINES[8]: ["bad_key"]}
    assert accepted.columns == columns and sorted(r["o_orderkey"] for r in accepted.collect()) == [1, 5, 6]
    one = accepted.where("o_orderkey = 1").first()
    assert tuple(one) == (1, 10, "F", "12.50", "1996-01-02", "1-URGENT")
    assert accepted.count() + rejected.count() == sum(bool(x.strip()) for x in LINES)


def test_headers_are_no_lines(spark, tmp_path):
    from conftest import DATA
    for table, n in (("orders", 10), ("lineitem", 13)):
        with open(os.path.join(DATA, f"{table}.csv")) as f:
            columns = f.readline().strip().lower().split("|")
        accepted, rejected = split_raw(spark, os.path.join(DATA, f"{table}.csv"), table, str(tmp_path / table), columns=columns)
        assert (accepted.count(), rejected.count()) == (n, 0)


# -- co-location ------------------------------------------------------------------

def _hot_lines(spark, share=3):
    """Lines of which a third have one order key."""
    orders, lineitem = clean_tables(spark, SF_SMALL)
    return orders, lineitem.withColumn("l_orderkey", F.when(
        F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_extendedprice"), F.lit(share)) == 0, F.lit(orders.first()["o_orderkey"])).otherwise(F.col("l_orderkey")))


def test_frequent_keys(spark):
    orders, lineitem = _hot_lines(spark)
    assert frequent_keys(lineitem, "l_orderkey", 0.05) == [orders.first()["o_orderkey"]]
    assert frequent_keys(orders, "o_orderkey", 0.05) == [] == frequent_keys(orders.limit(0), "o_orderkey", 0.05)
    assert frequent_keys(spark.createDataFrame([(None,), (None,), (1,)], "k long"), "k", 0.5) == []


def test_cold_keys_join_without_an_exchange(spark, tmp_path):
    orders, lineitem = _hot_lines(spark)
    stored = store_colocated(spark, orders, lineitem, "colocated_test", str(tmp_path), buckets=8, share=0.05)
    assert len(stored.hot_keys) == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cold = gold.order_facts(stored.table(spark, "orders_cold"), stored.table(spark, "lineitem_cold"))
        plan = cold._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
        daily = gold.revenue_by_order_date(stored.facts(spark))
        assert _rows(daily) == _rows(plain_sql(spark, DAILY, orders, lineitem).select(daily.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The key with a third of the lines is in no bucket, and each bucket has its share.
    by_file = [r["count"] for r in stored.table(spark, "lineitem_cold").groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(by_file) < 2 * lineitem.count() * 2 / 3 / 8
    assert stored.table(spark, "lineitem_hot").count() > lineitem.count() / 4
    catalog.drop_layer(spark, "colocated_test", cascade=True)
    assert (tmp_path / "lineitem_cold").exists()
