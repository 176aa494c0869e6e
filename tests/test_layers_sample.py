"""End-to-end over the 10-order / 13-line sample: bronze, silver, gold and the
analyst SQL, with the golden values of the sample."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import analyst, checks
from strata.schemas import REVENUE_BY_ORDER_DATE, TOP_CUSTOMERS
from strata.sinks import tables as T


def _t(job, spark, layer, table):
    return job.read(spark, layer, table)


class TestBronze:
    def test_counts_match_raw(self, spark, sample_run):
        assert _t(sample_run, spark, "bronze", "orders").count() == 10
        assert _t(sample_run, spark, "bronze", "lineitem").count() == 13

    def test_orders_columns(self, spark, sample_run):
        cols = set(_t(sample_run, spark, "bronze", "orders").columns)
        assert {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority", "o_clerk", "o_shippriority", "o_comment"} <= cols

    def test_money_and_dates_stay_text(self, spark, sample_run):
        types = dict(_t(sample_run, spark, "bronze", "lineitem").dtypes)
        assert types["l_extendedprice"] == "string" and types["l_shipdate"] == "string"


class TestSilver:
    def test_orders_typed(self, spark, sample_run):
        types = dict(_t(sample_run, spark, "silver", "orders").dtypes)
        assert types["o_totalprice"] == "decimal(15,2)"
        assert types["o_orderdate"] == "date"
        assert types["order_year"] == "int" and types["order_month"] == "int"
        assert types["_ingested_at"] == "timestamp"

    def test_partitioned_by_year(self, spark, sample_run):
        import os
        folders = {d for d in os.listdir(sample_run.paths["silver", "orders"]) if "=" in d}
        assert folders == {f"order_year={y}" for y in (1992, 1993, 1994, 1995, 1996, 1998)}

    def test_lineitem_revenue_golden(self, spark, sample_run):
        li = _t(sample_run, spark, "silver", "lineitem")
        assert dict(li.dtypes)["revenue"] == "decimal(32,4)"
        got = rows(li, "l_orderkey", "l_linenumber", "revenue", "ship_year")
        assert got[:3] == [(1, 1, Decimal("23721.9360"), 1996),
                           (1, 2, Decimal("31713.9732"), 1996),
                           (2, 1, Decimal("34850.2800"), 1997)]
        assert (5, 2, Decimal("26773.7514"), 1994) in got
        assert (34, 1, Decimal("22122.9008"), 1998) in got
        assert len(got) == 13

    def test_no_null_keys(self, spark, sample_run):
        orders = _t(sample_run, spark, "silver", "orders")
        assert orders.filter("o_orderkey IS NULL").count() == 0
        checks.assert_check(checks.null_keys(orders, "o_orderkey"), null_keys=0)


class TestGold:
    def test_schemas(self, spark, sample_run):
        daily = _t(sample_run, spark, "gold", "revenue_by_order_date")
        top = _t(sample_run, spark, "gold", "top_customers")
        assert [(f.name, f.dataType) for f in daily.schema.fields] == \
            [(f.name, f.dataType) for f in REVENUE_BY_ORDER_DATE.fields]
        assert [(f.name, f.dataType) for f in top.schema.fields] == \
            [(f.name, f.dataType) for f in TOP_CUSTOMERS.fields]

    def test_daily_revenue_golden(self, spark, sample_run):
        daily = _t(sample_run, spark, "gold", "revenue_by_order_date")
        got = rows(daily, "order_date", "total_revenue", "line_count", "order_count")
        assert len(got) == 10
        assert got[0] == (dt.date(1992, 2, 21), Decimal("44191.6756"), 1, 1)
        assert got[1] == (dt.date(1993, 10, 14), Decimal("117423.1650"), 2, 1)
        assert got[6] == (dt.date(1996, 1, 2), Decimal("55435.9092"), 2, 1)

    def test_top_customers_golden(self, spark, sample_run):
        top = _t(sample_run, spark, "gold", "top_customers")
        report = analyst.top_n_customers(top, 10).collect()
        assert [r["customer_key"] for r in report] == \
            [1234, 370, 1301, 557, 670, 445, 781, 1369, 611, 392]
        assert report[0]["total_revenue"] == Decimal("117423.1650")
        full = top.collect()
        assert all(r["order_count"] == 1 for r in full)
        assert all(r["first_order_date"] == r["last_order_date"] for r in full)

    def test_revenue_positive(self, spark, sample_run):
        daily = _t(sample_run, spark, "gold", "revenue_by_order_date")
        total = analyst.total_revenue(daily).first()[0]
        assert total == Decimal("449237.1333")
        checks.assert_check(checks.revenue_positive(daily), non_positive=0)

    def test_top_customer_ordering(self, spark, sample_run):
        top = _t(sample_run, spark, "gold", "top_customers")
        report = analyst.top_n_customers(top, 10)
        checks.assert_check(checks.sorted_desc(report, "total_revenue", "customer_key"),
                            checked_rows=10, out_of_order=0)


class TestSQLQueries:
    @pytest.fixture(autouse=True)
    def _sample_names(self, spark, sample_run):
        sample_run.register_tables(spark)     # other tests may re-point layer.table

    def test_yearly_rollup_on_catalog_table(self, spark, sample_run):
        got = analyst.yearly_revenue_sql(spark, "gold.revenue_by_order_date").collect()
        assert [(r[0], r[1], r[2]) for r in got] == [
            (1992, Decimal("44191.6756"), 1), (1993, Decimal("159613.4131"), 2),
            (1994, Decimal("41548.4274"), 1), (1995, Decimal("72190.1960"), 2),
            (1996, Decimal("109570.5204"), 3), (1998, Decimal("22122.9008"), 1)]

    def test_top_days_1996(self, spark, sample_run):
        daily = spark.table("gold.revenue_by_order_date")
        got = [tuple(r) for r in analyst.top_days(daily, 1996).collect()]
        assert got == [(dt.date(1996, 1, 2), Decimal("55435.9092"), 1),
                       (dt.date(1996, 12, 1), Decimal("34850.2800"), 1),
                       (dt.date(1996, 1, 10), Decimal("19284.3312"), 1)]

    def test_top_10_customers_sql(self, spark, sample_run):
        got = spark.sql("""SELECT customer_key, total_revenue, order_count
                           FROM gold.top_customers
                           ORDER BY total_revenue DESC, customer_key LIMIT 10""").collect()
        assert 1 <= len(got) <= 10

    def test_run_metrics(self, spark, sample_run):
        assert [sample_run.row_count("bronze", t) for t in ("orders", "lineitem")] == [10, 13]
        assert [sample_run.row_count("gold", t) for t in ("revenue_by_order_date", "top_customers")] == [10, 10]
        frame = sample_run.metrics(spark)
        assert frame.count() == 6 and set(frame.columns) == {
            "phase", "table_name", "row_count", "duration_s"}

    def test_catalog_inspection(self, spark, sample_run):
        names = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
        assert {"bronze", "silver", "gold"} <= names
        desc = {r[0]: r[1] for r in spark.sql("DESCRIBE silver.orders").collect()}
        assert desc["o_totalprice"] == "decimal(15,2)"


def test_rerun_gives_identical_tables(spark, tmp_path):
    """Running the whole job twice yields the same rows in every table
    (apart from the audit timestamp), each in a directory of its own."""
    from conftest import DATA
    from strata.plans.layers import LayerJob
    root = str(tmp_path)
    one, two = (LayerJob(source=DATA, root=root, source_format="text").run(spark) for _ in range(2))
    assert len(one.paths) == 6 and not set(one.paths.values()) & set(two.paths.values())
    for key in one.paths:
        a, b = (job.read(spark, *key).drop("_ingested_at") for job in (one, two))
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        assert T.current_path(spark, root, *key).endswith(two.paths[key].split("/")[-1])


def test_bronze_matches_raw_lines(spark, sample_run):
    import os

    from conftest import DATA
    for table, n in (("orders", 10), ("lineitem", 13)):
        r = checks.bronze_matches_raw(spark, os.path.join(DATA, f"{table}.csv"),
                                      _t(sample_run, spark, "bronze", table), table).first()
        assert (r["raw_rows"], r["bronze_rows"], r["equal"]) == (n, n, True)


def test_an_unfinished_directory_is_not_read(spark, tmp_path):
    import os
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/l/t/data-20990101T000000000000-dead")
    os.remove(f"{root}/l/t/data-20990101T000000000000-dead/_SUCCESS")
    with pytest.raises(ValueError):
        T.current_path(spark, root, "l", "t")
    done = T.publish(spark, root, "l", "t", spark.range(5))
    assert done.row_count == 5 and T.read_current(spark, root, "l", "t").count() == 5


def test_gold_removes_its_own_staging(spark, tmp_path):
    import os

    from conftest import DATA
    from strata.plans.layers import LayerJob
    root = str(tmp_path)
    other = os.path.join(root, "staging", "someone-elses")
    os.makedirs(other)
    LayerJob(source=DATA, root=root, source_format="text").run(spark)
    assert os.listdir(os.path.join(root, "staging")) == ["someone-elses"]


def test_sortedness_check_finds_disorder(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 50, 1, 99])], "k long, v long").coalesce(1)
    checks.assert_check(checks.sorted_desc(df, "v", "k"), checked_rows=4, out_of_order=2)
    ties = spark.createDataFrame([(2, 9), (1, 9), (3, None), (4, 1)], "k long, v long").coalesce(1)
    checks.assert_check(checks.sorted_desc(ties, "v", "k"), checked_rows=4, out_of_order=2)
    checks.assert_check(checks.sorted_desc(df.limit(0), "v", "k"), checked_rows=0, out_of_order=0)


@pytest.mark.parametrize("block", [65_536, 7])
def test_sortedness_over_many_tasks(spark, monkeypatch, block):
    """Violations inside blocks, between blocks and between tasks, some of them empty."""
    monkeypatch.setattr(checks, "BLOCK_ROWS", block)
    table = spark.range(0, 5000, numPartitions=6).select((-F.col("id")).alias("v"), F.col("id").alias("k")).where(
        "k < 800 OR k > 2600")                                       # one task has no row
    checks.assert_check(checks.sorted_desc(table, "v", "k"), checked_rows=800 + 2399, out_of_order=0)
    swapped = F.when(F.col("k") == 100, -102).when(F.col("k") == 833, 10**6).when(F.col("k").isin(2601, 4166), None).otherwise(F.col("v"))
    spoiled = table.withColumn("v", swapped)
    values = [(r["v"], r["k"]) for r in spoiled.collect()]
    key = lambda v: -10**9 if v is None else v
    want = sum(key(a) < key(b) or (a == b and x > y) for (a, x), (b, y) in zip(values, values[1:]))
    assert want >= 3
    checks.assert_check(checks.sorted_desc(spoiled, "v", "k"), checked_rows=len(values), out_of_order=want)
    last_first = spark.range(0, 90, numPartitions=9).select(F.col("id").alias("v"), F.col("id").alias("k"))
    checks.assert_check(checks.sorted_desc(last_first, "v", "k"), checked_rows=90, out_of_order=89)


def test_sortedness_needs_no_single_task(spark):
    plan = checks.sorted_desc(spark.range(100).withColumn("v", -F.col("id")), "v", "id")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_task" in line.split("windowspecdefinition(")[1] for line in windows)


def test_top_n_complete_detects_a_wrong_report(spark, sample_run):
    top = _t(sample_run, spark, "gold", "top_customers")
    good = analyst.top_n_customers(top, 3)
    checks.assert_check(checks.top_n_complete(top, good, "total_revenue", "customer_key"),
                        report_rows=3, missed=0)
    wrong = top.orderBy("total_revenue").limit(3).select("customer_key", "total_revenue")
    r = checks.top_n_complete(top, wrong, "total_revenue", "customer_key").first()
    assert r["missed"] == 7


SAMPLE_MONEY = {"orders": ("o_totalprice",), "lineitem": ("l_quantity", "l_extendedprice", "l_discount")}


def _acceptance(spark, job, counts=None, money=None):
    from strata.plans.acceptance import acceptance
    return {r.check_name: r.passed for r in
            acceptance(spark, job, counts or {"orders": 10, "lineitem": 13}, money or SAMPLE_MONEY).collect()}


def test_acceptance_report(spark, sample_run):
    got = _acceptance(spark, sample_run)
    assert len(got) == 6 and all(got.values())
    assert not _acceptance(spark, sample_run, {"orders": 11, "lineitem": 13})["bronze_rows_match_source"]


@pytest.mark.parametrize("spoil, check", [
    (("bronze", "orders", lambda df: df.limit(9), None), "bronze_rows_match_source"),
    (("silver", "orders", lambda df: df.withColumn("o_totalprice", F.col("o_totalprice").cast("double")), "order_year"),
     "silver_money_is_decimal_15_2"),
    (("silver", "lineitem", lambda df: df.drop("l_discount"), "ship_year"), "silver_money_is_decimal_15_2"),
    (("silver", "orders", lambda df: df, None), "silver_partitioned_by_year"),
    (("silver", "lineitem", lambda df: df.withColumn("l_orderkey", F.lit(None).cast("long")), "ship_year"), "silver_no_null_keys"),
    (("gold", "revenue_by_order_date", lambda df: df.withColumn("total_revenue", -F.col("total_revenue")), None),
     "gold_revenue_positive"),
])
def test_a_spoiled_table_fails_its_check(spark, sample_run, tmp_path, spoil, check):
    import copy
    layer, table, change, partition_by = spoil
    job = copy.copy(sample_run)
    done = T.publish(spark, str(tmp_path), layer, table, change(sample_run.read(spark, layer, table)), partition_by)
    job.paths = sample_run.paths | {(layer, table): done.path}
    assert [c for c, ok in _acceptance(spark, job).items() if not ok] == [check]


def _all_files(*jobs):
    import os
    return {os.path.join(at, f) for job in jobs for p in job.paths.values() for at, _, files in os.walk(p) for f in files}


def test_teardown_deletes_only_this_runs_data(spark, tmp_path):
    from conftest import DATA
    from strata.plans.layers import LayerJob
    root = str(tmp_path / "a root with 'marks")
    first, second = (LayerJob(source=DATA, root=root, source_format="text", register=True).run(spark) for _ in range(2))
    before = _all_files(first)
    assert spark.table("silver.orders").count() == 10
    second.drop_tables(spark, with_data=True)
    assert not spark.catalog.tableExists("silver.orders")
    assert not _all_files(second) and _all_files(first) == before
    assert first.read(spark, "silver", "orders").count() == 10


@pytest.mark.parametrize("with_data", [False, True])
def test_teardown_leaves_other_roots_alone(spark, tmp_path, with_data):
    """Whoever made the databases, and wherever the names point by now."""
    from conftest import DATA
    from strata.plans.layers import LayerJob
    a, b = (LayerJob(source=DATA, root=str(tmp_path / r), source_format="text", register=True).run(spark) for r in "ab")
    files, own = _all_files(a), _all_files(b)
    b.drop_tables(spark, with_data=with_data)
    assert _all_files(a) == files and _all_files(b) == (set() if with_data else own)
    assert not spark.catalog.tableExists("gold.top_customers")
    a.register_tables(spark)
    assert spark.table("gold.top_customers").count() == 10
    b.drop_tables(spark)                                    # the names are not b's any more
    assert spark.table("gold.top_customers").count() == 10
    a.drop_tables(spark, with_data=with_data)
    assert _all_files(a) == (set() if with_data else files) and _all_files(b) == (set() if with_data else own)


def test_a_database_of_this_run_goes_when_it_holds_nothing(spark, tmp_path):
    """The only run of its databases: they go, its files stay unless asked for."""
    from conftest import DATA
    from strata.plans.layers import LayerJob
    from strata.sinks import catalog
    for layer in ("bronze", "silver", "gold"):
        catalog.drop_layer(spark, layer, cascade=True)      # only names go, which others declare anew
    job = LayerJob(source=DATA, root=str(tmp_path / "only"), source_format="text", register=True).run(spark)
    files, made = _all_files(job), set(job.made)
    job.drop_tables(spark, with_data=False)
    assert _all_files(job) == files and len(files) > 6
    assert made and not job.made and not any(spark.catalog.databaseExists(layer) for layer in made)


def test_sequential_and_concurrent_runs_agree(spark, tmp_path):
    from conftest import DATA
    from strata.plans.layers import LayerJob
    a = LayerJob(source=DATA, root=str(tmp_path / "a"), source_format="text", parallel=False)
    b = LayerJob(source=DATA, root=str(tmp_path / "b"), source_format="text", parallel=True)
    a.run(spark)
    b.run(spark)
    for layer, table in [("silver", "lineitem"), ("gold", "revenue_by_order_date"),
                         ("gold", "top_customers")]:
        x, y = (job.read(spark, layer, table).drop("_ingested_at") for job in (a, b))
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0
    counted = lambda job: {(r["phase"], r["table_name"], r["row_count"]) for r in job.stored}
    assert counted(a) == counted(b)
