"""Write-side guards: rebalanced partitioned writes, wider files than declared."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from strata.plans.sources import clean_tables
from strata.sinks.writes import write_table


def _files(path):
    return sum(1 for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_rebalanced_partitioned_write(spark, tmp_path):
    orders = clean_tables(spark, SF_SMALL)[0].repartition(8)
    years = orders.select("order_year").distinct().count()
    write_table(orders, str(tmp_path / "plain"), partition_by="order_year")
    write_table(orders, str(tmp_path / "rebal"), partition_by="order_year", rebalance=True)
    assert _files(tmp_path / "rebal") < _files(tmp_path / "plain")
    assert _files(tmp_path / "rebal") >= years
    assert spark.read.parquet(str(tmp_path / "rebal")).count() == orders.count()


def test_a_file_wider_than_declared_is_refused(spark, tmp_path):
    import pytest

    from strata.sources.delimited import read_delimited
    path = tmp_path / "orders.csv"
    path.write_text("o_orderkey|o_custkey|o_orderstatus\n1|2|F\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(path), "orders", columns=["o_orderkey", "o_custkey"]).collect()
    assert read_delimited(spark, str(path), "orders", columns=["o_orderkey", "o_custkey", "o_orderstatus"]).count() == 1


def test_scratch_needs_a_shared_folder_off_local_masters():
    import pytest

    from strata.session import ensure_checkpoint_dir

    class Nothing:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Nothing()

    class Session:
        sparkContext, conf = Context(), Nothing()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_partitioned_writes_keep_files_open_instead_of_sorting(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from strata.sinks.writes import overwrite_partitions
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before, real = spark.conf.get(name), DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (seen.append(int(spark.conf.get(name))), real(w, *a, **k)))
    rows = spark.range(200).selectExpr("id", "id % 40 AS part")     # more values than open files
    write_table(rows, str(tmp_path / "t"), partition_by="part")
    overwrite_partitions(rows.where("part = 3 AND id < 100"), str(tmp_path / "t"), "part")
    assert len(seen) == 2 and min(seen) > 0 and spark.conf.get(name) == before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 198


def test_the_clean_layer_is_stored_without_a_shuffle(spark, tmp_path, monkeypatch):
    from strata.plans import layers
    real, seen = layers.T.publish, {}

    def publish(spark, root, layer, table, df, partition_by=None, rebalance=False):
        seen[layer, table] = rebalance
        return real(spark, root, layer, table, df, partition_by, rebalance)

    monkeypatch.setattr(layers.T, "publish", publish)
    job = layers.LayerJob(source=SF_SMALL, root=str(tmp_path / "wh")).run(spark)
    assert not seen["silver", "orders"] and not seen["silver", "lineitem"]
    assert seen["gold", "revenue_by_order_date"]
    assert job.read(spark, "silver", "lineitem").count() == clean_tables(spark, SF_SMALL)[1].count()
