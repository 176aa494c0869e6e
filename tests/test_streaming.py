"""Available-now streaming ingest picks up only new raw files, exactly once."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.sources.delimited import as_raw_text, write_delimited
from strata.streaming import clean_new_rows, ingest_new_files


def test_incremental_ingest(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    cols = orders.columns
    raw, bronze, silver = (str(tmp_path / d) for d in ("raw", "bronze", "silver"))
    ck_b, ck_s = str(tmp_path / "ck_b"), str(tmp_path / "ck_s")
    early = orders.filter(F.col("o_orderkey") % 2 == 0)
    late = orders.filter(F.col("o_orderkey") % 2 == 1)

    write_delimited(as_raw_text(early, "orders"), f"{raw}/drop1")
    n1 = ingest_new_files(spark, raw, "orders", bronze, ck_b, columns=cols, recursive=True)
    assert n1 == early.count()
    assert ingest_new_files(spark, raw, "orders", bronze, ck_b, columns=cols, recursive=True) == 0

    write_delimited(as_raw_text(late, "orders"), f"{raw}/drop2")
    n2 = ingest_new_files(spark, raw, "orders", bronze, ck_b, columns=cols, recursive=True)
    assert n2 == late.count()
    got = spark.read.parquet(bronze)
    assert got.count() == orders.count()
    assert got.select("o_orderkey").distinct().count() == orders.count()

    assert clean_new_rows(spark, bronze, "orders", silver, ck_s) == orders.count()
    s = spark.read.parquet(silver)
    assert dict(s.dtypes)["o_totalprice"] == "decimal(15,2)"
    assert s.count() == orders.count()


def _lines(tmp_path, name, keys, days_old=0):
    import os
    import time
    path = tmp_path / "raw" / name
    path.parent.mkdir(exist_ok=True)
    path.write_text("o_orderkey|o_custkey\n" + "".join(f"{k}|1\n" for k in keys))
    stamp = time.time() - days_old * 86_400
    os.utime(path, (stamp, stamp))


def test_an_old_file_that_arrives_late_is_ingested(spark, tmp_path):
    raw, bronze, ck = (str(tmp_path / d) for d in ("raw", "bronze", "ck"))
    _lines(tmp_path, "new.csv", [1])
    cols = ["o_orderkey", "o_custkey"]
    assert ingest_new_files(spark, raw, "orders", bronze, ck, columns=cols) == 1
    _lines(tmp_path, "late.csv", [2], days_old=30)
    assert ingest_new_files(spark, raw, "orders", bronze, ck, columns=cols) == 1
    assert sorted(r[0] for r in spark.read.parquet(bronze).select("o_orderkey").collect()) == [1, 2]


def test_rows_are_counted_beyond_the_kept_progress(spark, tmp_path):
    raw, bronze, ck = (str(tmp_path / d) for d in ("raw", "bronze", "ck"))
    for i in range(6):
        _lines(tmp_path, f"{i}.csv", [i], days_old=6 - i)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        n = ingest_new_files(spark, raw, "orders", bronze, ck, columns=["o_orderkey", "o_custkey"], max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert n == 6
