"""Tables stored in an order: range-partitioned, locally sorted files.

Every file holds a range of the order, and file names count up along it, so the ranges of
two files share at most the value at which they meet.  Readers gain by it twice: a
predicate on the leading column skips the files (by their statistics) that lie outside, and
a top-N read opens only the first files (``first_rows``).

A value that holds a large share of the rows is split over several files: rows are dealt
out by the order columns and then by a hash of the whole row, so no task gets more than
its share of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ordering(by: list[tuple[str, str]]) -> list[Column]:
    """Sort columns of (name, "asc" or "desc"); NULL first when rising, last when falling."""
    for _, way in by:
        if way not in ("asc", "desc"):
            raise ValueError(f"order by {way}: asc or desc")
    return [F.asc_nulls_first(c) if way == "asc" else F.desc_nulls_last(c) for c, way in by]


def write_clustered(df: DataFrame, path: str, by: list[tuple[str, str]], files: int, mode: str = "overwrite") -> None:
    """Write ``df`` as about ``files`` files in the order ``by``.  Spark samples the
    order columns to choose the ranges; nothing is sorted beyond a file."""
    own = df.withColumn("_row", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    dealt = own.repartitionByRange(files, *ordering(by), F.col("_row"))
    dealt.sortWithinPartitions(*ordering(by), "_row").drop("_row").write.mode(mode).parquet(path)


def ranges(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file, row_count, low, high) of every file, along the order."""
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy("file")


def first_rows(spark: SparkSession, path: str, by: list[tuple[str, str]], n: int) -> DataFrame:
    """The first ``n`` rows of the order, from the first files that hold them: counts come
    from file metadata (one row a file reaches the driver), and the rest isn't opened."""
    counts = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name")).count()
    files, rows = [], 0
    for r in counts.orderBy("name").toLocalIterator():
        if rows >= n:
            break
        files.append(r["file"])
        rows += r["count"]
    whole = spark.read.parquet(path)
    if not files:
        return whole.limit(0)
    # The files' own names, as Spark gave them; their folder is the table's.
    names = [f.rsplit("/", 1)[-1] for f in files]
    return spark.read.schema(whole.schema).parquet(*[f"{path.rstrip('/')}/{name}" for name in names]).orderBy(*ordering(by)).limit(n)
