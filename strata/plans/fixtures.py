"""Raw text derived from the source tables, for ingest round trips.

``clean_text`` renders a source table the way raw TPC-H text carries it.
``dirty_orders_lines`` renders *every* order as a ``.tbl``-style line (no
header, trailing delimiter) and spoils some of them by fixed rules on the
key, so the expected result of the tolerant read and of the clean layer can
be stated independently in SQL:

* key % 7 = 0  -> key written as ``x<key>``         (read: NULL key, gated out)
* key % 11 = 5 -> line cut after the customer key    (missing fields: NULL)
* key % 11 = 6 -> one extra field at the end         (dropped by the reader)
* key % 5 = 0  -> price ``n/a``                      (NULL price)
* key % 5 = 2  -> price with a third decimal ``5``   (rounds half up: +0.01)
* key % 5 = 3  -> price ``12345678901234.00``        (too large: NULL)
* key % 5 = 1  -> date without zero padding          (NULL when month or day < 10)
* key % 5 = 4  -> date ``<year>-13-40``              (NULL)

``dirty_lineitem_lines`` does the same for lineitem, by r = (order key +
line number) % 6:

* r = 0 -> quantity ``abc``                           (NULL)
* r = 1 -> extended price with a third decimal ``5``  (rounds half up: +0.01)
* r = 2 -> discount empty                             (NULL, so revenue NULL)
* r = 3 -> ship date without zero padding             (NULL when month or day < 10)
* r = 4 -> tax ``12345678901234.00``                  (too large: NULL)
* r = 5 -> clean

These rules pick rows to *spoil*; every row is still written and read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import to_money
from strata.sources.delimited import as_raw_text, write_delimited
from strata.sources.tables import read_parquet_table

# The spoiled text used by the dirty-row fixture.
BAD_PRICE = "n/a"
OVERFLOW_PRICE = "12345678901234.00"


def write_clean_text(spark: SparkSession, sf_dir: str, table: str, path: str) -> list[str]:
    """Write ``table`` as pipe-delimited text with a header; returns its columns."""
    src = read_parquet_table(spark, sf_dir, table)
    write_delimited(as_raw_text(src, table), path)
    return src.columns


def _price_text(key: Column, price: Column) -> Column:
    base = to_money(price).cast("string")
    return (F.when(key % 5 == 0, F.lit(BAD_PRICE))
             .when(key % 5 == 2, F.concat(base, F.lit("5")))
             .when(key % 5 == 3, F.lit(OVERFLOW_PRICE))
             .otherwise(base))


def _date_text(key: Column, day: Column) -> Column:
    return (F.when(key % 5 == 1, F.date_format(day, "yyyy-M-d"))
             .when(key % 5 == 4, F.concat(F.year(day).cast("string"), F.lit("-13-40")))
             .otherwise(F.date_format(day, "yyyy-MM-dd")))


def dirty_orders_lines(orders: DataFrame) -> DataFrame:
    """One ``value`` line per order, spoiled by the rules above."""
    k = F.col("o_orderkey")
    key_text = F.when(k % 7 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(
        k.cast("string"))
    full = F.concat_ws(
        "|", key_text, F.col("o_custkey").cast("string"), F.col("o_orderstatus"),
        _price_text(k, F.col("o_totalprice")), _date_text(k, F.col("o_orderdate")),
        F.col("o_orderpriority"))
    line = (F.when(k % 11 == 5, F.concat_ws("|", key_text, F.col("o_custkey").cast("string")))
             .when(k % 11 == 6, F.concat(full, F.lit("|extra")))
             .otherwise(full))
    return orders.select(F.concat(line, F.lit("|")).alias("value"))


def write_dirty_orders(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    orders = read_parquet_table(spark, sf_dir, "orders")
    dirty_orders_lines(orders).write.mode("overwrite").text(path)
    return orders.columns


# The spoiled text of the lineitem fixture.
BAD_QUANTITY = "abc"


def dirty_lineitem_lines(lineitem: DataFrame) -> DataFrame:
    """One ``.tbl``-style line per line item, spoiled by the rules above."""
    r = (F.col("l_orderkey") + F.col("l_linenumber")) % 6

    def money(name):
        return to_money(F.col(name)).cast("string")

    fields = [
        F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.when(r == 0, F.lit(BAD_QUANTITY)).otherwise(money("l_quantity")),
        F.when(r == 1, F.concat(money("l_extendedprice"), F.lit("5")))
         .otherwise(money("l_extendedprice")),
        F.when(r == 2, F.lit("")).otherwise(money("l_discount")),
        F.when(r == 4, F.lit(OVERFLOW_PRICE)).otherwise(money("l_tax")),
        F.col("l_returnflag"), F.col("l_linestatus"),
        F.when(r == 3, F.date_format("l_shipdate", "yyyy-M-d"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")),
    ]
    return lineitem.select(F.concat(F.concat_ws("|", *fields), F.lit("|")).alias("value"))


def write_dirty_lineitem(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    lineitem = read_parquet_table(spark, sf_dir, "lineitem")
    dirty_lineitem_lines(lineitem).write.mode("overwrite").text(path)
    return lineitem.columns
