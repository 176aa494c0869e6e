"""Upserts, compaction, schema steps and copying, also where the fixtures never go."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.operators import analyst, evolution
from strata.plans.sources import clean_tables
from strata.sinks import tables as T
from strata.sinks import upkeep
from strata.sinks.writes import upsert, upsert_partitions, write_table


@pytest.fixture()
def orders(spark):
    return clean_tables(spark, SF_SMALL)[0]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _files(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


# -- upsert -------------------------------------------------------------------

def test_a_partition_that_loses_all_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "a b" / "t")
    schema = "k long, y string, v string"
    write_table(spark.createDataFrame([(1, "a:b", "old"), (2, "92", "stays"), (3, None, "nul")], schema), path, "y")
    touched = upsert_partitions(spark, path, spark.createDataFrame([(1, "93", "moved"), (3, "92", "moved")], schema), "k", "y")
    assert set(touched) == {"a:b", "93", "92", None}
    assert _rows(spark.read.schema(schema).parquet(path).select("k", "y", "v")) == [(1, "93", "moved"), (2, "92", "stays"), (3, "92", "moved")]


def test_partition_text_that_looks_like_a_number(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, m string, v string"
    write_table(spark.createDataFrame([(1, "01", "a"), (2, "02", "b"), (3, "1", "c")], schema), path, "m")
    upsert_partitions(spark, path, spark.createDataFrame([(1, "02", "moved")], schema), "k", "m")
    stored = spark.read.schema(schema).parquet(path).select("k", "m", "v")
    assert _rows(stored) == [(1, "02", "moved"), (2, "02", "b"), (3, "1", "c")]


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path, orders):
    path = str(tmp_path / "orders")
    write_table(orders, path, partition_by="order_year")
    listing = lambda: {d: _files(os.path.join(path, d)) for d in os.listdir(path) if "=" in d}
    before = listing()
    updates = orders.filter("order_year = 1995").withColumn("o_orderstatus", F.lit("U"))
    assert upsert_partitions(spark, path, updates, "o_orderkey", "order_year") == [1995]
    after = listing()
    assert {d for d in before if before[d] != after[d]} == {"order_year=1995"}
    assert spark.read.parquet(path).filter("o_orderstatus = 'U'").count() == updates.count()


def test_updates_that_do_not_fit_are_refused(spark, tmp_path, orders):
    path, root = str(tmp_path / "p"), str(tmp_path / "w")
    write_table(orders, path, partition_by="order_year")
    T.publish(spark, root, "silver", "orders", orders, "order_year")
    few = orders.limit(3)
    for wrong in (few.unionByName(few.limit(1)), few.withColumn("extra", F.lit(1)), few.drop("o_custkey"),
                  few.withColumn("order_month", F.col("order_month").cast("long"))):
        with pytest.raises(ValueError):
            upsert_partitions(spark, path, wrong, "o_orderkey", "order_year")
        with pytest.raises(ValueError):
            upkeep.upsert_table(spark, root, "silver", "orders", wrong, "o_orderkey", "order_year")
    assert len(T.written(spark, root, "silver", "orders")) == 1
    assert _rows(upsert(orders, few, "o_orderkey")) == _rows(orders)


# -- compaction ---------------------------------------------------------------

@pytest.mark.parametrize("value_type, values", [
    ("string", ["a:b", "01", "02", None]), ("string", ["01", "02", "1", "003"]), ("int", [1, 2, 3, None])])
def test_compaction_shrinks_every_small_partition(spark, tmp_path, value_type, values):
    path = str(tmp_path / "a root" / "t")
    rows = [(i, values[i % 4]) for i in range(400)]
    df = spark.createDataFrame(rows, f"k long, p {value_type}")
    write_table(df.repartition(8), path, "p")
    folders = [d for d in os.listdir(path) if "=" in d]
    assert all(len(_files(os.path.join(path, d))) > 1 for d in folders)
    done = upkeep.compact(spark, path, "p", max_files=10)
    assert {d.value for d in done} == {None if v is None else str(v) for v in values}
    assert [len(_files(os.path.join(path, d))) for d in folders] == [1] * 4
    assert not [d for d in os.listdir(path) if d.startswith("_comp")]
    stored = spark.read.schema(f"k long, p {value_type}").parquet(path).select("k", "p")
    assert _rows(stored) == sorted(rows, key=repr)


def test_bins_are_packed_first_fit():
    bins = upkeep.first_fit({"a": 60, "b": 50, "c": 40, "d": 30, "e": 20, "f": 5}, 100)
    assert bins == [["a", "c"], ["b", "d", "e"], ["f"]]
    assert upkeep.first_fit({}, 10) == []
    sizes = {f"f{i:03}": 1 + i * 37 % 63 for i in range(500)}
    bins = upkeep.first_fit(sizes, 128)
    assert sorted(f for own in bins for f in own) == sorted(sizes) and all(sum(sizes[f] for f in own) <= 128 for own in bins)
    assert len(bins) <= 1.05 * sum(sizes.values()) / 128 + 1


@pytest.mark.parametrize("partition_by", [None, "order_year"])
def test_large_files_keep_their_names(spark, tmp_path, orders, partition_by):
    """A table of large and small files: only small ones are packed, and only with others."""
    path = str(tmp_path / "a table" / "t")
    write_table(orders.filter("order_year <= 1996").coalesce(1), path, partition_by)
    big = {r["file"]: r["size"] for r in upkeep.table_files(spark, path, partition_by).collect()}
    for year in (1995, 1996):
        write_table(orders.filter(f"order_year = {year}").repartition(5), path, partition_by, mode="append")
    write_table(orders.filter("order_year = 1997").coalesce(1), path, partition_by, mode="append")
    both = orders.filter("order_year <= 1997").unionByName(orders.filter("order_year IN (1995, 1996)"))
    before = {r["file"] for r in upkeep.table_files(spark, path, partition_by).collect()}
    limit = min(big.values())
    small = {r["file"] for r in upkeep.table_files(spark, path, partition_by).where(F.col("size") < limit).collect()}
    assert len(small) >= 10 and not small & set(big)
    done = upkeep.compact(spark, path, partition_by, small_file_bytes=limit, target_file_bytes=10 * limit)
    after = {r["file"] for r in upkeep.table_files(spark, path, partition_by).collect()}
    assert set(big) <= after and len(after) < len(before)
    assert sum(d.files_before for d in done) == len(before - after) and sum(d.files_after for d in done) == len(after - before)
    stored = spark.read.parquet(path)
    assert _rows(stored.select(orders.columns)) == _rows(both)
    assert upkeep.compact(spark, path, partition_by, small_file_bytes=limit, target_file_bytes=10 * limit) == []


def test_files_that_fit_with_no_other_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(20_000).select("id", F.lit(1).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("s")).repartition(6), path, "p")
    sizes = [r["size"] for r in upkeep.table_files(spark, path, "p").collect()]
    assert upkeep.compact(spark, path, "p", target_file_bytes=int(1.5 * max(sizes))) == []
    assert [(d.files_before, d.files_after) for d in upkeep.compact(spark, path, "p", target_file_bytes=int(2.1 * max(sizes)))] == [(6, 3)]
    assert len(_files(f"{path}/p=1")) == 3
    assert spark.read.parquet(path).select("id").distinct().count() == spark.read.parquet(path).count() == 20_000


@pytest.mark.parametrize("dies", ["while writing", "before the list", "while moving"])
def test_a_compaction_that_died(spark, tmp_path, monkeypatch, orders, dies):
    path = str(tmp_path / "t")
    write_table(orders.repartition(6), path, "order_year")
    real = upkeep.finish_compaction
    calls = []

    def lost(*args, **kwargs):
        calls.append(1)
        if len(calls) > 1:
            raise OSError("the driver is lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(upkeep, "finish_compaction", lost)
    with pytest.raises(OSError):
        upkeep.compact(spark, path, "order_year")
    monkeypatch.setattr(upkeep, "finish_compaction", real)
    staging, = [d for d in os.listdir(path) if d.startswith(upkeep.STAGING)]
    assert _rows(spark.read.parquet(path).select(orders.columns)) == _rows(orders)      # hidden from readers
    if dies == "while moving":                          # some new files are in place, all old ones too
        year = next(d for d in os.listdir(f"{path}/{staging}") if "=" in d)
        for f in _files(f"{path}/{staging}/{year}"):
            os.rename(f"{path}/{staging}/{year}/{f}", f"{path}/{year}/{f}")
    elif dies == "before the list":
        os.remove(f"{path}/{staging}/{upkeep.PLAN}/_SUCCESS")
    upkeep.compact(spark, path, "order_year")
    assert _rows(spark.read.parquet(path).select(orders.columns)) == _rows(orders)
    assert all(len(_files(f"{path}/{d}")) == 1 for d in os.listdir(path) if "=" in d)


# -- schema steps -------------------------------------------------------------

def test_schema_steps(spark, orders):
    again = evolution.add_column(evolution.drop_column(orders, "O_OrderStatus", "order_year"), "o_orderstatus", "string")
    assert again.filter("o_orderstatus IS NOT NULL").count() == 0 and again.count() == orders.count()
    assert evolution.rename_column(orders, "o_custkey", "customer").columns[1] == "customer"
    assert dict(evolution.widen_column(orders, "ORDER_MONTH", "bigint").dtypes)["order_month"] == "bigint"
    view = evolution.register(evolution.add_column(orders, "note", "string"), "orders_with_note")
    assert spark.sql(f"SELECT count(note) FROM {view}").first()[0] == 0


@pytest.mark.parametrize("step", [
    lambda df: evolution.add_column(df, "O_CUSTKEY", "string"),
    lambda df: evolution.drop_column(df, "nothing"),
    lambda df: evolution.drop_column(df, "ORDER_YEAR", "order_year"),
    lambda df: evolution.rename_column(df, "nothing", "x"),
    lambda df: evolution.rename_column(df, "o_custkey", "O_ORDERKEY"),
    lambda df: evolution.rename_column(df, "Order_Year", "year", "order_year"),
    lambda df: evolution.widen_column(df, "nothing", "bigint"),
    lambda df: evolution.widen_column(df, "o_orderkey", "int"),
    lambda df: evolution.widen_column(df, "o_totalprice", "decimal(15,2)"),
    lambda df: evolution.widen_column(df, "o_totalprice", "decimal(15,3)"),
])
def test_schema_steps_refuse(orders, step):
    with pytest.raises(ValueError):
        step(orders)


# -- copy, personas -----------------------------------------------------------

def test_copy_compares_both_sides(spark, tmp_path, orders):
    src, dst = str(tmp_path / "a"), str(tmp_path / "b")
    T.publish(spark, src, "silver", "orders", orders.limit(3))
    T.publish(spark, src, "silver", "orders", orders, "order_year")
    T.publish(spark, src, "silver", "empty", orders.limit(0))
    rows = {r["table_name"]: r for r in upkeep.copy_tables(spark, src, dst, {("silver", "orders"): "order_year"}).collect()}
    assert rows["orders"]["copied_rows"] == orders.count() and rows["empty"]["copied_rows"] == 0
    assert all(r["same_rows"] for r in rows.values())
    with pytest.raises(ValueError):
        upkeep.copy_tables(spark, str(tmp_path / "none"), dst)


def test_personas_are_denied_by_default(spark, orders):
    daily = spark.createDataFrame([(1996, 1.0, 2)], "order_year int, total_revenue double, order_count long")
    assert analyst.restricted(daily, "data_analyst", "revenue_by_order_date").columns == ["order_year", "total_revenue"]
    for persona, table in (("nobody", "revenue_by_order_date"), ("data_analyst", "top_customers")):
        with pytest.raises(PermissionError):
            analyst.restricted(daily, persona, table)
    with pytest.raises(PermissionError):
        analyst.register_views(spark, {"revenue_by_order_date": daily}, persona="nobody")
    assert analyst.register_views(spark, {"revenue_by_order_date": daily, "top_customers": daily},
                                  persona="data_analyst") == ["gold_revenue_by_order_date"]
