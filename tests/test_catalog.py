"""Catalog operations: namespaces, registration, CTAS, views, drops."""

from __future__ import annotations

from conftest import SF_SMALL
from strata.operators import analyst
from strata.plans.sources import gold_tables
from strata.sinks import catalog
from strata.sinks.writes import write_table


def test_declare_ctas_views_and_drop(spark, tmp_path):
    daily = gold_tables(spark, SF_SMALL)["revenue_by_order_date"]
    fqn, folder = "gold_t.revenue_by_order_date", str(tmp_path / "gold t")
    catalog.create_layer(spark, "gold_t", folder)
    assert "gold_t" in {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    for name, rows in (("daily", daily), ("daily2", daily.filter("order_year = 1996"))):
        path = str(tmp_path / name)
        write_table(rows, path, partition_by="order_year")
        catalog.declare_table(spark, fqn, spark.read.parquet(path).schema, path, "order_year")
        assert spark.table(fqn).count() == rows.count()      # no partition of the first is left in the second

    catalog.create_view(spark, "v_daily", f"SELECT * FROM {fqn}")
    assert spark.table("v_daily").count() == spark.table(fqn).count()

    ctas = catalog.create_table_as(spark, "gold_t.yearly",
                                   f"SELECT order_year, SUM(total_revenue) AS rev "
                                   f"FROM {fqn} GROUP BY order_year")
    assert ctas.count() == 1
    at = tmp_path / "gold t" / catalog.layer_location(spark, "gold_t").rsplit("/", 1)[-1] / "yearly"
    assert at.exists()                                        # managed tables lie in the database's location
    assert not catalog.drop_layer(spark, "gold_t")            # it holds tables
    catalog.drop_table(spark, "gold_t.yearly", purge=True)
    assert not at.exists()
    catalog.drop_table(spark, fqn)
    assert catalog.is_empty(spark, "gold_t")
    at.mkdir()
    (at / "note").write_text("somebody's")
    assert not catalog.drop_layer(spark, "gold_t") and (at / "note").exists()
    (at / "note").unlink()
    assert catalog.drop_layer(spark, "gold_t")
    assert all((tmp_path / name).exists() for name in ("daily", "daily2"))
    assert "gold_t" not in {r[0] for r in spark.sql("SHOW DATABASES").collect()}


def test_persona_views(spark):
    tables = gold_tables(spark, SF_SMALL)
    names = analyst.register_views(spark, tables, persona="data_analyst")
    assert "gold_revenue_by_order_date" in names
    assert spark.table("gold_revenue_by_order_date").columns == ["order_year", "total_revenue"]
    assert names == ["gold_revenue_by_order_date"]             # a table not listed is denied
    analyst.register_views(spark, tables)
    assert "line_count" in spark.table("gold_revenue_by_order_date").columns


def test_declared_gold_ddl(spark, tmp_path):
    from strata.schemas import REVENUE_BY_ORDER_DATE
    daily = gold_tables(spark, SF_SMALL)["revenue_by_order_date"]
    path = str(tmp_path / "daily")
    write_table(daily, path, partition_by="order_year")
    catalog.create_layer(spark, "gold_ddl", str(tmp_path / "ddl"))
    fqn = catalog.declare_table(spark, "gold_ddl.revenue_by_order_date", REVENUE_BY_ORDER_DATE,
                                path, partition_by="order_year")
    types = dict(spark.table(fqn).dtypes)
    assert types["total_revenue"] == "decimal(38,4)" and types["order_date"] == "date"
    assert spark.table(fqn).count() == daily.count()
    assert spark.sql(f"SELECT count(*) FROM {fqn} WHERE order_year = 1996").first()[0] == \
        daily.filter("order_year = 1996").count()
    catalog.drop_layer(spark, "gold_ddl", cascade=True)


def _rows(n, shift=0, *more):
    from pyspark.sql import functions as F
    return lambda spark: spark.range(n).select("id", *more, ((F.col("id") + shift) % 3).cast("int").alias("p"))


def test_readers_find_a_table_while_it_is_republished(spark, tmp_path):
    """A reader in another session loops over the name and a view of it while the
    name is switched; it sees one table or another, never none."""
    import threading

    catalog.create_layer(spark, "swap", str(tmp_path / "dbs"))
    sizes = (30, 60, 90)
    for n in sizes:
        write_table(_rows(n)(spark), str(tmp_path / f"v{n}"), "p")
    point = lambda n: catalog.declare_table(
        spark, "swap.t", spark.read.parquet(str(tmp_path / "v30")).schema, str(tmp_path / f"v{n}"), "p")
    point(30)
    catalog.publish_view(spark, "swap.v", "SELECT p, count(*) AS n FROM swap.t GROUP BY p")
    seen, failed, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            own = spark.newSession()
            try:
                seen.add(own.table("swap.t").count())
                seen.add(own.sql("SELECT sum(n) FROM swap.v").first()[0])
            except Exception as e:  # noqa: BLE001 - any failure of a reader is the finding
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for n in sizes * 8:
        point(n)
        assert spark.table("swap.t").where("p = 1").count() == n // 3
    stop.set()
    reader.join()
    assert not failed and len(seen) > 1 and seen <= set(sizes)
    catalog.drop_layer(spark, "swap", cascade=True)


def test_re_pointing_adds_columns_and_replaces_others(spark, tmp_path):
    from pyspark.sql import functions as F
    catalog.create_layer(spark, "again", str(tmp_path / "dbs"))
    wide = _rows(6, 0, F.lit("x").alias("note"))(spark)
    other = _rows(6)(spark).withColumn("id", F.col("id").cast("string"))
    for name, df in (("a", _rows(9)(spark)), ("b", wide), ("c", other)):
        write_table(df, str(tmp_path / name), "p")
        catalog.declare_table(spark, "again.t", spark.read.parquet(str(tmp_path / name)).schema, str(tmp_path / name), "p")
        got = spark.table("again.t")
        assert got.columns == df.columns and got.dtypes == df.dtypes and got.count() == df.count()
    assert catalog.points_at(spark, "again.t", f"{tmp_path}/c") and not catalog.points_at(spark, "again.t", f"{tmp_path}/a")
    assert catalog.table_location(spark, "again.none") is None
    catalog.drop_layer(spark, "again", cascade=True)


def test_persona_views_stay_in_the_catalog(spark, tmp_path):
    import pytest
    tables = gold_tables(spark, SF_SMALL)
    catalog.create_layer(spark, "kept", str(tmp_path / "dbs"))
    catalog.create_layer(spark, "for_analyst", str(tmp_path / "dbs"))
    daily = tables["revenue_by_order_date"]
    for name, rows in (("one", daily.where("order_year = 1995")), ("two", daily)):
        write_table(rows, str(tmp_path / name), "order_year")
        schema = spark.read.parquet(str(tmp_path / name)).schema
        catalog.declare_table(spark, "kept.revenue_by_order_date", schema, str(tmp_path / name), "order_year")
        views = analyst.publish_persona_views(spark, "data_analyst", "kept", "for_analyst")
        assert views == ["for_analyst.revenue_by_order_date"]
        other = spark.newSession()
        got = other.table("for_analyst.revenue_by_order_date")
        assert got.columns == ["order_year", "total_revenue"] and got.count() == rows.count()
    with pytest.raises(PermissionError):
        analyst.publish_persona_views(spark, "nobody", "kept", "for_analyst")
    assert catalog.drop_layer(spark, "for_analyst", cascade=True) and catalog.drop_layer(spark, "kept", cascade=True)
    assert (tmp_path / "two").exists()
