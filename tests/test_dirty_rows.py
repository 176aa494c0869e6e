"""Tolerant ingest: PERMISSIVE reading, try-casts under ANSI, and the key gate."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import DATA
from strata.functions.casts import to_day, to_money
from strata.operators import silver
from strata.sources.delimited import read_delimited

DIRTY_SCHEMA = StructType([
    StructField("K", LongType(), False), StructField("P", StringType(), True),
    StructField("D", StringType(), True), StructField("S", StringType(), True)])


def test_dirty_rows(spark):
    raw = read_delimited(spark, os.path.join(DATA, "dirty.csv"), "dirty", schema=DIRTY_SCHEMA)
    typed = raw.select("K", to_money(F.col("P")).alias("P"),
                       to_day(F.col("D"), StringType()).alias("D"), "S")
    got = {r["S"]: (r["K"], r["P"], r["D"]) for r in typed.collect() if r["S"]}
    assert got["a"] == (1, Decimal("10.50"), dt.date(1996, 1, 2))
    assert got["badkey"] == (None, Decimal("11.00"), dt.date(1996, 1, 3))
    assert got["nullkey"] == (None, Decimal("12.00"), dt.date(1996, 1, 4))
    assert got["badprice"] == (3, None, None)
    assert got["shortdate"] == (4, None, None)
    assert got["round"] == (5, Decimal("1.01"), dt.date(1996, 2, 3))
    assert got["overflow"] == (7, None, dt.date(1996, 2, 3))
    missing = [r for r in typed.collect() if r["K"] == 6][0]
    assert missing["P"] == Decimal("7.00") and missing["D"] is None and missing["S"] is None
    assert typed.filter(F.col("K").isNotNull()).count() == 6


def test_key_gate_counts(spark):
    raw = read_delimited(spark, os.path.join(DATA, "orders.csv"), "orders",
                         columns=["o_orderkey", "o_custkey", "o_orderstatus",
                                  "o_totalprice", "o_orderdate"])
    spoiled = raw.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, None)
                             .otherwise(F.col("o_orderkey")))
    r = silver.key_gate_counts(spoiled, "orders").first()
    assert (r["rows_in"], r["rows_kept"], r["rows_dropped"]) == (10, 5, 5)
    assert silver.clean_orders(spoiled).count() == 5


def test_tbl_without_header_keeps_first_row(spark, tmp_path):
    path = tmp_path / "orders.tbl"
    path.write_text("1|11|P|100.25|2001-03-04|low|someone|0|c|\n"
                    "2|12|F|7.50|2002-05-06|high|someone|0|c|\n")
    df = read_delimited(spark, str(path), "orders", header=False)
    assert df.count() == 2
    assert sorted(r["o_orderkey"] for r in df.collect()) == [1, 2]
    assert df.filter(F.col("o_comment") == "c").count() == 2


def test_clean_accepts_typed_parquet(spark):
    src = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    cleaned = silver.clean_orders(src, audit=False)
    types = dict(cleaned.dtypes)
    assert types["o_totalprice"] == "decimal(15,2)" and types["o_orderdate"] == "date"
    assert cleaned.count() == src.count()


def test_job_reads_tbl_files(spark, tmp_path):
    from strata.plans.layers import LayerJob
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "orders.tbl").write_text(
        "1|11|P|100.25|2001-03-04|low|someone|0|c|\n"
        "2|12|F|7.50|2002-05-06|high|someone|0|c|\n")
    (raw / "lineitem.tbl").write_text(
        "1|5|6|1|3|90.00|0.10|0.01|A|F|2001-04-01|2001-04-02|2001-04-03|none|air|c|\n"
        "2|7|8|1|1|8.00|0.25|0.00|R|O|2002-06-01|2002-06-02|2002-06-03|none|sea|c|\n")
    job = LayerJob(source=str(raw), root=str(tmp_path / "wh"), source_format="text",
                   header=False, suffix=".tbl")
    job.run(spark)
    daily = job.read(spark, "gold", "revenue_by_order_date")
    assert sorted(r["total_revenue"] for r in daily.collect()) == [Decimal("6.0000"), Decimal("81.0000")]
    assert job.row_count("silver", "lineitem") == 2


def test_raw_rows_without_header(spark, tmp_path):
    from strata.operators import checks
    d = tmp_path / "raw"
    d.mkdir()
    (d / "a.tbl").write_text("1|x|\n2|y|\n\n")
    (d / "b.tbl").write_text("3|z|\n")
    assert checks.raw_rows(spark, str(d), header=False).first()[0] == 3
    (d / "c.csv").write_text("k|v\n4|w\n")
    assert checks.raw_rows(spark, str(d / "c.csv"), header=True).first()[0] == 1
