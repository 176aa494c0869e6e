"""Gold kept up to date by changes, against gold computed from the changed tables."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest

from conftest import CUSTOMERS, DAILY, plain_sql
from strata.plans import maintenance
from strata.plans.maintenance import Changes

ORDER = "o_orderkey long, o_custkey long, o_orderdate date, order_year int, order_month int"
LINE = "l_orderkey long, revenue decimal(32,4)"
DAY = {n: dt.date(1994 + n, 3, 1 + n) for n in range(6)}


def orders(spark, rows):
    return spark.createDataFrame([(k, c, d, d and d.year, d and d.month) for k, c, d in rows], ORDER)


def lines(spark, rows):
    return spark.createDataFrame([(k, None if r is None else Decimal(r)) for k, r in rows], LINE)


def keys(spark, *deleted):
    return spark.createDataFrame([(k,) for k in deleted], "o_orderkey long")


BASE_ORDERS = [(1, 10, DAY[0]), (2, 10, DAY[1]), (3, 20, DAY[1]), (4, None, DAY[2]), (5, 30, None), (6, 40, DAY[3]),
               (7, 50, DAY[4]), (7, 50, DAY[4]), (7, 60, DAY[5]), (8, 70, DAY[5])]
BASE_LINES = [(1, "1.5"), (1, "2"), (2, "3"), (3, "4"), (4, "5"), (5, "6"), (6, None), (7, "7"), (7, "8"), (99, "9")]


def _files(root, table):
    at = os.path.join(root, table)
    return {d: sorted(f for f in os.listdir(os.path.join(at, d)) if f.endswith(".parquet")) for d in os.listdir(at) if "=" in d}


def _same(spark, root, order_rows, line_rows):
    o, l = orders(spark, order_rows), lines(spark, line_rows)  # noqa: E741
    for table, sql in (("revenue_by_order_date", DAILY), ("top_customers", CUSTOMERS)):
        want = plain_sql(spark, sql, o, l)
        got = maintenance.read(spark, root, table)
        assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect())), table


@pytest.fixture()
def root(spark, tmp_path):
    path = str(tmp_path / "live gold")
    maintenance.build(spark, path, orders(spark, BASE_ORDERS), lines(spark, BASE_LINES))
    _same(spark, path, BASE_ORDERS, BASE_LINES)
    return path


STEPS = {
    "a moved date, also to and from none": (
        [(1, 10, DAY[3]), (5, 30, DAY[0]), (2, 10, None)], [], []),
    "another customer, also none": ([(3, 10, DAY[1]), (4, 20, DAY[2]), (1, None, DAY[0])], [], []),
    "an order that goes takes its lines along": ([], [], [1, 7, 12345]),
    "new orders and lines, and the half that waited": ([(99, 20, DAY[1]), (100, 80, DAY[2])], [(100, "1"), (100, "2"), (8, "3"), (101, "4")], []),
    "other lines": ([], [(1, "100"), (6, "1"), (7, "0.5")], []),
    "deleted and given again": ([(1, 20, DAY[0]), (7, 50, DAY[4])], [(7, "9")], [1, 7]),
    "copies of an order": ([(2, 10, DAY[1]), (2, 10, DAY[1]), (2, 20, DAY[0])], [], []),
    "nothing": ([], [], []),
}


def changed(order_rows, line_rows, step):
    new_orders, new_lines, gone = step
    order_keys, line_keys = {k for k, *_ in new_orders} | set(gone), {k for k, _ in new_lines} | set(gone)
    return ([r for r in order_rows if r[0] not in order_keys] + new_orders,
            [r for r in line_rows if r[0] not in line_keys] + new_lines)


def _apply(spark, root, step):
    return maintenance.apply(spark, root, Changes(orders(spark, step[0]), lines(spark, step[1]), keys(spark, *step[2])))


@pytest.mark.parametrize("name", sorted(STEPS))
def test_each_change(spark, root, name):
    _apply(spark, root, STEPS[name])
    _same(spark, root, *changed(BASE_ORDERS, BASE_LINES, STEPS[name]))


def test_changes_one_after_the_other(spark, root):
    state = BASE_ORDERS, BASE_LINES
    for name in sorted(STEPS, reverse=True):
        _apply(spark, root, STEPS[name])
        state = changed(*state, STEPS[name])
    _same(spark, root, *state)


def test_untouched_partitions_keep_their_files(spark, root):
    before = {t: _files(root, t) for t in maintenance.LAYOUT}
    done = _apply(spark, root, STEPS["another customer, also none"])
    after = {t: _files(root, t) for t in maintenance.LAYOUT}
    differ = {t: {d for d in before[t] | after[t] if before[t].get(d) != after[t].get(d)} for t in before}
    years = {"order_year=1994", "order_year=1995", "order_year=1996"}
    assert differ["revenue_by_order_date"] == years and differ["order_facts"] == years
    assert set(done.rewritten["order_facts"]) == {1994, 1995, 1996}
    # Customers 10, 20 and none: no other customer's directory is written.
    assert differ["top_customers"] == {f"customer_part={p}" for p in done.rewritten["top_customers"]} and len(differ["top_customers"]) <= 3
    assert _apply(spark, root, STEPS["nothing"]).rewritten == {t: [] for t in maintenance.LAYOUT}
    assert {t: _files(root, t) for t in maintenance.LAYOUT} == after


@pytest.mark.parametrize("dies_at", ["revenue_by_order_date", "top_customers", "order_facts"])
def test_a_run_that_died_can_be_repeated(spark, root, monkeypatch, dies_at):
    real = maintenance.replace_keys

    def dies(spark, path, *args):
        if path.endswith(dies_at):
            raise OSError("the driver is lost")
        return real(spark, path, *args)

    step = STEPS["a moved date, also to and from none"]
    monkeypatch.setattr(maintenance, "replace_keys", dies)
    with pytest.raises(OSError):
        _apply(spark, root, step)
    monkeypatch.setattr(maintenance, "replace_keys", real)
    _apply(spark, root, step)
    _same(spark, root, *changed(BASE_ORDERS, BASE_LINES, step))


def test_daily_groups_are_looked_for_in_their_years(spark, root):
    from strata.sinks.writes import is_in
    from pyspark.sql import functions as F
    facts = spark.read.parquet(f"{root}/order_facts").where(is_in(F.col("order_year"), [1995, None]))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "order_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0] for r in facts.select("order_year").distinct().collect()} == {1995, None}


def test_changes_are_read_once(spark, root):
    """Neither the lines nor the orders of a change set are read again for each table."""
    step = STEPS["new orders and lines, and the half that waited"]
    seen = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    o, l = orders(spark, step[0]), lines(spark, step[1])  # noqa: E741
    maintenance.apply(spark, root, Changes(o.mapInPandas(pass_on, ORDER), l.mapInPandas(pass_on, LINE), keys(spark)))
    assert seen.value == len(step[0]) + len(step[1])
    _same(spark, root, *changed(BASE_ORDERS, BASE_LINES, step))
