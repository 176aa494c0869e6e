"""Plain (unversioned) table writes.

Parquet directories, optionally partitioned by one identity column.  Writes
go through Spark's file commit protocol, so a lost executor's task is simply
re-run; only committed task output becomes visible.

A whole-table overwrite of a path that the same query reads is unsafe with
the path writer (it clears the target before the read happens): rewrite such
a table through ``strata.sinks.tables``, which always writes a new directory.  A dynamic partition overwrite may read its own target: output is
staged and only the touched directories are replaced when the job commits.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType


#: Files of different partition values that a task writes side by side, and the most bytes
#: that one of them holds back in memory (a Parquet row group).
OPEN_FILES = 16
ROW_GROUP_BYTES = 32 * 1024 * 1024


@contextmanager
def side_by_side(spark) -> Iterator[None]:
    """Partitioned writes meanwhile keep a file open for each partition value instead of
    sorting a task's rows by it, which takes memory for all of them and spills.  From the
    ``OPEN_FILES``-th value of a task on, its other rows are sorted.  A session that has
    set a number of its own keeps it.  Threads that write together: enter once, around
    all of them."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    if int(before) > 0:
        yield
        return
    spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_table(df: DataFrame, path: str, partition_by: str | list[str] | None = None,
                mode: str = "overwrite", observe: Observation | None = None,
                rebalance: bool = False) -> None:
    """Create-or-replace (default) or append a Parquet table at ``path``.

    No sort before the write: order is applied by readers, and the files of a task's
    partition values are written ``side_by_side``.  ``observe`` counts the written rows
    during the write itself.

    ``rebalance`` (partitioned writes) adds one shuffle by the partition
    column under Spark's REBALANCE hint: adaptive execution splits each
    partition value's data into advisory-size chunks (a year holding a third
    of the table becomes many tasks) and merges small ones, so each directory
    gets a few right-sized files instead of one small file per input task.
    The plan asks for it wherever the caller does; a session that turns
    adaptive execution off gets one task per value.
    """
    cols = [] if not partition_by else (
        [partition_by] if isinstance(partition_by, str) else list(partition_by))
    if rebalance and cols:
        df = df.hint("rebalance", *cols)
    if observe is not None:
        df = df.observe(observe, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode(mode)
    if not cols:
        writer.parquet(path)
        return
    with side_by_side(df.sparkSession):
        writer.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(*cols).parquet(path)


def read_typed(spark, path: str, column: str, data_type: DataType) -> DataFrame:
    """The table at ``path`` with partition column ``column`` read as ``data_type``.
    Spark guesses a partition column's type from its directories' names, so that text
    such as 01 would be read as the number 1, and written back elsewhere."""
    fields = [StructField(f.name, data_type if f.name == column else f.dataType, True)
              for f in spark.read.parquet(path).schema.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: str | list[str]) -> None:
    """Replace only the partitions present in ``df``; all others are kept.

    Uses Spark's dynamic partition-overwrite mode as a per-write option, so
    the session setting is untouched.  ``df`` may read from ``path``: output
    is staged, and the touched directories are replaced at job commit.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    with side_by_side(df.sparkSession):
        (df.write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .option("parquet.block.size", ROW_GROUP_BYTES)
           .partitionBy(*cols)
           .parquet(path))


def upsert(base: DataFrame, updates: DataFrame, key: str | list[str]) -> DataFrame:
    """Keyed upsert as a DataFrame: rows of ``base`` whose key is not in
    ``updates``, plus every row of ``updates``.

    Columns are matched by name and must be the table's, with its types: a
    column too many or too few, or of another type, is refused.  The anti join
    shuffles both sides on the key (or broadcasts ``updates`` when AQE measures it
    small); a hot key on the ``base`` side is split by AQE's skew-join handling,
    since nothing downstream needs the key partitioning.  Updates that repeat a key
    make the result ambiguous: ``refuse_duplicate_keys`` before writing.
    """
    refuse_other_columns(base, updates)
    keys = [key] if isinstance(key, str) else list(key)
    kept = base.join(updates.select(*keys), keys, "left_anti").select(*base.columns)
    return kept.unionByName(updates)


def refuse_other_columns(base: DataFrame, updates: DataFrame) -> None:
    odd = sorted(set(base.dtypes) ^ set(updates.dtypes))
    if odd:
        raise ValueError(f"updates differ from the table in {odd}")


def refuse_duplicate_keys(df: DataFrame, key: str | list[str]) -> None:
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"updates repeat a value of {key}")


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that occur more than once (partial aggregation before the shuffle)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def checksum(df: DataFrame) -> DataFrame:
    """Order-insensitive fingerprint of a table: row count and the sum of a
    64-bit hash of every row.  One scan, no shuffle beyond the final merge."""
    h = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(h).alias("row_hash_sum"))


def is_in(column, values) -> Column:
    """Null-safe ``column`` IN ``values``, as literals that prune partitions."""
    some = [v for v in values if v is not None]
    found = column.isin(*some) if some else F.lit(False)
    return F.coalesce(found, F.lit(False)) | column.isNull() if len(some) < len(values) else found


def by_key(left: DataFrame, keyed: DataFrame, key: str | list[str], how: str, unique: bool = False) -> DataFrame:
    """Rows of ``left`` whose key is in ``keyed`` (``left_semi``) or isn't (``left_anti``).
    NULL is a key like others.  ``unique``: ``keyed`` holds each key once, and is joined
    without a shuffle that finds its distinct ones."""
    keys = [key] if isinstance(key, str) else list(key)
    right = keyed.select(*[F.col(k).alias(f"_{k}") for k in keys])
    right = right if unique else right.distinct()
    return left.join(right, reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys]), how)


def replace_keys(spark, path: str, gone: DataFrame, rows: DataFrame, key: str | list[str], partition_by: str,
                 unique: bool = False) -> list:
    """Every row of the partitioned table at ``path`` whose key is in ``gone`` goes (a
    NULL key is one like others), and ``rows`` come in.  Only the partitions that lose or
    receive a row are read and written back, by one dynamic partition overwrite; the
    others' files stay as they are.  A partition that loses all its rows is no part of
    that and is then overwritten with an empty one: which ones do is known from how many
    rows each has and how many of them go.  ``unique``: ``gone`` holds each key once.
    Returns the touched partition values, which are all that reaches the driver (one for
    each directory at most).
    """
    base = read_typed(spark, path, partition_by, rows.schema[partition_by].dataType)
    keys = [key] if isinstance(key, str) else list(key)
    directory = F.regexp_replace(F.first("file"), "/[^/]+$", "").alias("directory")
    counted = F.count(F.lit(1)).alias("n")
    losing = by_key(base.select(*dict.fromkeys([*keys, partition_by])), gone, keys, "left_semi", unique).groupBy(
        partition_by).agg(counted).collect()
    new = {r[0] for r in rows.select(partition_by).distinct().collect()}
    touched = list({**{r[0]: None for r in losing}, **dict.fromkeys(new)})
    if not touched:
        return []
    held = {r[0]: r for r in base.filter(is_in(F.col(partition_by), [r[0] for r in losing])).select(
        partition_by, F.col("_metadata.file_path").alias("file")).groupBy(partition_by).agg(counted, directory).collect()}
    kept = by_key(base.filter(is_in(F.col(partition_by), touched)), gone, keys, "left_anti", unique)
    overwrite_partitions(kept.unionByName(rows.select(*base.columns)), path, partition_by)
    for r in losing:
        if r["n"] == held[r[0]]["n"] and r[0] not in new:
            empty = spark.createDataFrame([], base.drop(partition_by).schema)
            empty.write.mode("overwrite").parquet(unquote(held[r[0]]["directory"]))
    return touched


def upsert_partitions(spark, path: str, updates: DataFrame, key: str | list[str],
                      partition_by: str) -> list:
    """Keyed upsert into a plain partitioned table, rewriting only the
    partitions it touches (MERGE by partition): those holding a row whose key is
    updated (an order whose year changes leaves its old partition) and those
    receiving an update.  See ``replace_keys``.  Returns the touched partition values.

    Updates that repeat a key, hold a NULL one, or differ from the table's columns raise
    before anything is written.  A job that fails before its commit changes nothing;
    run again after a later failure, it finds the emptied partitions' old rows
    still updated elsewhere and empties them then.
    """
    keys = [key] if isinstance(key, str) else list(key)
    refuse_duplicate_keys(updates, keys)
    if partition_by not in updates.columns:
        raise ValueError(f"updates have no column {partition_by}")
    if not updates.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).isEmpty():
        raise ValueError(f"updates hold a NULL in {keys}")
    base = read_typed(spark, path, partition_by, updates.schema[partition_by].dataType)
    refuse_other_columns(base, updates)
    return replace_keys(spark, path, updates, updates, keys, partition_by, unique=True)
