"""Write a table into a fresh directory, then let readers switch to it.

``<root>/<layer>/<table>/data-<time>-<id>/`` holds one write each.  Spark's file
commit puts ``_SUCCESS`` there last, so the newest directory that has it is the
table; a job that dies half-way leaves a directory nobody reads.  There is no log
and nothing here deletes: older directories are the user's to keep or remove.  One
writer per table is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from strata.sinks.writes import write_table


@dataclass(frozen=True)
class Published:
    path: str
    row_count: int


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def publish(spark: SparkSession, root: str, layer: str, table: str, df: DataFrame,
            partition_by: str | None = None, rebalance: bool = False) -> Published:
    """Write ``df`` as the table's new content; rows are counted by the write."""
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    path = f"{table_path(root, layer, table)}/data-{stamp}-{uuid.uuid4().hex[:8]}"
    seen = Observation(f"{layer}.{table}.{stamp}")
    write_table(df, path, partition_by, observe=seen, rebalance=rebalance)
    return Published(path, int(seen.get.get("rows", 0)))


def written(spark: SparkSession, root: str, layer: str, table: str) -> list[str]:
    """Finished directories of the table, oldest first (one directory listing)."""
    fs, at = _fs(spark, table_path(root, layer, table))
    if not fs.exists(at):
        return []
    path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("data-")]
    return sorted(p.toString() for p in found if fs.exists(path_class(p, "_SUCCESS")))


def current_path(spark: SparkSession, root: str, layer: str, table: str) -> str:
    found = written(spark, root, layer, table)
    if not found:
        raise ValueError(f"{layer}.{table}: nothing written under {root}")
    return found[-1]


def read_current(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, root, layer, table))


def tables_under(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(layer, table) of every table written under ``root``."""
    fs, at = _fs(spark, root)
    names = lambda p: [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
    path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted((layer, table) for layer in names(at) for table in names(path_class(at, layer))
                  if written(spark, root, layer, table))


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_own(spark: SparkSession, path: str) -> None:
    """Delete a directory that the calling job wrote in the same run."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
