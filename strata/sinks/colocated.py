"""Orders and lines stored for a join without an exchange, whatever keys are frequent.

Both tables are bucketed by order key into the same number of buckets, so the gold join and
the sums per order read them where they lie.  A bucket can't be split by its reader, so a key
with a large share of the lines would make one bucket, and one task, as large as that share.
Such keys are found first (a frequent-items sketch in one pass, then exact counts of its
few candidates) and stored apart, unbucketed: their lines are spread over all files and
summed where they lie before any exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold
from strata.sinks.catalog import create_layer

#: Share of the lines above which a key is stored apart; a bucket holds about one in BUCKETS.
HOT_SHARE = 0.001
BUCKETS = 64
SIDES = ("orders_cold", "orders_hot", "lineitem_cold", "lineitem_hot")


def frequent_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Values of ``key`` with more than ``share`` of the rows: at most 1 / share of them.
    The sketch misses none; what it has too many goes by exact count."""
    found = df.where(F.col(key).isNotNull()).stat.freqItems([key], share).first()
    candidates = list(found[0]) if found and found[0] else []
    if not candidates:
        return []
    total = F.count(F.lit(1))
    counts = df.groupBy(F.when(F.col(key).isin(candidates), F.col(key)).alias("key")).agg(total.alias("n")).collect()
    rows = sum(r["n"] for r in counts)
    return sorted(r["key"] for r in counts if r["key"] is not None and r["n"] > share * rows)


@dataclass(frozen=True)
class Colocated:
    """Names of the four tables of a database."""
    database: str
    hot_keys: tuple

    def table(self, spark: SparkSession, side: str) -> DataFrame:
        return spark.table(f"`{self.database}`.{side}")

    def facts(self, spark: SparkSession, columns=gold.FACT_COLUMNS) -> DataFrame:
        """``gold.order_facts``: cold keys without an exchange, hot ones from sums."""
        side = lambda which: gold.order_facts(
            self.table(spark, f"orders_{which}"), self.table(spark, f"lineitem_{which}"), columns)
        return side("cold").unionByName(side("hot"))


def store_colocated(spark: SparkSession, orders: DataFrame, lineitem: DataFrame, database: str, root: str,
                    buckets: int = BUCKETS, share: float = HOT_SHARE) -> Colocated:
    """Store both tables, hot keys apart, as tables of ``database`` with files under
    ``root``.  One shuffle each puts the cold rows into their buckets, one file a bucket."""
    create_layer(spark, database, f"{root.rstrip('/')}/_catalog")
    hot = frequent_keys(lineitem, "l_orderkey", share)
    for name, df, key in (("orders", orders, "o_orderkey"), ("lineitem", lineitem, "l_orderkey")):
        is_hot = F.col(key).isin(hot) if hot else F.lit(False)
        cold = df.where(F.coalesce(~is_hot, F.lit(True))).repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        for side, writer in (("cold", cold), ("hot", df.where(is_hot).write)):
            path = f"{root.rstrip('/')}/{name}_{side}"
            writer.mode("overwrite").format("parquet").option("path", path).saveAsTable(f"`{database}`.{name}_{side}")
    return Colocated(database, tuple(hot))
