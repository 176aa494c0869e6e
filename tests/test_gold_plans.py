"""The gold plan equals a plain SQL join (also with copied
orders, NULL dates and NULL revenue), and its physical plan has the intended
shape: pruned scans, pushed filters, partial aggregation before exchanges."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import CUSTOMERS, DAILY, SF_SMALL, plain_sql
from strata.operators import analyst, gold
from strata.plans.sources import clean_tables


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _with_copies_and_nulls(orders, lineitem):
    k = F.col("o_orderkey")
    copies = orders.filter(k % 13 == 0)
    hot = orders.filter(k == orders.agg(F.min("o_orderkey")).first()[0])
    for _ in range(5):                      # one key copied many times
        copies = copies.unionByName(hot)
    moved = orders.filter(k % 17 == 0).withColumn("o_orderdate", F.lit(None).cast("date")) \
        .withColumns({c: F.lit(None).cast("int") for c in ("order_year", "order_month")})
    orders2 = orders.unionByName(copies).unionByName(moved)
    lineitem2 = lineitem.withColumn(
        "revenue", F.when(F.col("l_orderkey") % 19 == 0, None).otherwise(F.col("revenue")))
    return orders2, lineitem2


def test_equal_to_plain_sql_on_source(spark):
    orders, lineitem = clean_tables(spark, SF_SMALL)
    g = gold.build_gold(orders, lineitem)
    _same(g["revenue_by_order_date"], plain_sql(spark, DAILY, orders, lineitem))
    _same(g["top_customers"], plain_sql(spark, CUSTOMERS, orders, lineitem))


def test_equal_to_plain_sql_with_copies_and_nulls(spark):
    orders, lineitem = _with_copies_and_nulls(*clean_tables(spark, SF_SMALL))
    for g in (gold.build_gold(orders, lineitem), dict(zip(
            ("revenue_by_order_date", "top_customers"),
            (f(gold.order_facts(orders, lineitem)) for f in (gold.revenue_by_order_date, gold.top_customers))))):
        _same(g["revenue_by_order_date"], plain_sql(spark, DAILY, orders, lineitem))
        _same(g["top_customers"], plain_sql(spark, CUSTOMERS, orders, lineitem))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pruning_and_pushdown(spark):
    orders, lineitem = clean_tables(spark, SF_SMALL)
    plan = _plan(gold.build_gold(orders, lineitem)["revenue_by_order_date"])
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    assert not [c for c in ("l_tax", "l_returnflag", "o_custkey", "o_orderstatus") if c in plan]


def test_partial_aggregation_before_lineitem_exchange(spark):
    orders, lineitem = clean_tables(spark, SF_SMALL)
    plan = _plan(gold.build_gold(orders, lineitem)["revenue_by_order_date"])
    exch = plan.index("Exchange hashpartitioning(l_orderkey")
    assert "partial_sum(revenue" in plan[exch:]
    # the distinct count needs no exchange of its own on the order key
    assert plan.count("Exchange hashpartitioning(o_orderdate") == 1


def test_top_n_is_take_ordered(spark):
    orders, lineitem = clean_tables(spark, SF_SMALL)
    top = gold.build_gold(orders, lineitem)["top_customers"]
    assert "TakeOrderedAndProject" in _plan(analyst.top_n_customers(top, 10))


def test_stored_table_year_filter_prunes_partitions(spark, tmp_path):
    orders, lineitem = clean_tables(spark, SF_SMALL)
    path = str(tmp_path / "daily")
    gold.build_gold(orders, lineitem)["revenue_by_order_date"].write \
        .partitionBy("order_year").parquet(path)
    plan = _plan(analyst.top_days(spark.read.parquet(path), 1996))
    assert "PartitionFilters: [isnotnull(order_year" in plan and "= 1996)" in plan
