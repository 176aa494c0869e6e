"""Session-catalog registration of stored tables (``layer.table``).

Layer tables are EXTERNAL Parquet tables over a directory that a job wrote:
dropping one leaves its files (``LayerJob.drop_tables(with_data=True)`` deletes
those of its own run).  Managed tables lie in their database's location, and go
with ``purge``.

``DROP DATABASE`` deletes the database's location with all that lies in it.  So a
database gets a folder of its own that holds no table (``create_layer``), and
``drop_layer`` drops one only if that folder holds nothing.

A name that is declared again with the same columns is re-pointed by one change
of its location: whoever reads it meanwhile finds the old table or the new one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_layer(spark: SparkSession, layer: str, location: str) -> bool:
    """Make the database if it is missing, at a fresh folder under ``location``, which
    nothing else is written to; whether this call made it."""
    if spark.catalog.databaseExists(layer):
        return False
    folder = f"{location.rstrip('/')}/{layer}-{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(layer)} LOCATION '{_text(folder)}'")
    return _same_path(spark, layer_location(spark, layer), folder)


def layer_location(spark: SparkSession, layer: str) -> str:
    return spark.catalog.getDatabase(layer).locationUri


def _stored_path(spark: SparkSession, location: str):
    """The path that a location in the catalog stands for.  The catalog writes it as a
    URI, with %20 for a space; what isn't one is a path as it stands."""
    jvm = spark.sparkContext._jvm
    try:
        uri = jvm.java.net.URI(location)
    except Exception:  # noqa: BLE001 - py4j wraps the syntax error
        return jvm.org.apache.hadoop.fs.Path(location)
    return jvm.org.apache.hadoop.fs.Path(uri)


def _same_path(spark: SparkSession, location: str | None, path: str) -> bool:
    if location is None:
        return False
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    full = lambda p: p.getFileSystem(conf).makeQualified(p).toString()
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return full(_stored_path(spark, location)) == full(own)


def table_location(spark: SparkSession, fqn: str) -> str | None:
    """Where the table's files lie, or None if there is no such table."""
    if not spark.catalog.tableExists(fqn):
        return None
    found = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_q(fqn)}").collect() if r["col_name"] == "Location"]
    return found[0] if found else None


def points_at(spark: SparkSession, fqn: str, path: str) -> bool:
    return _same_path(spark, table_location(spark, fqn), path)


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def is_empty(spark: SparkSession, layer: str) -> bool:
    return spark.catalog.databaseExists(layer) and all(
        t.isTemporary for t in spark.catalog.listTables(layer))


#: Partitions are found in the table's location, so that moving it moves them all.
_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"


def declare_table(spark: SparkSession, fqn: str, schema: StructType, path: str,
                  partition_by: str | None = None) -> str:
    """Explicit DDL: ``CREATE TABLE fqn (typed columns) USING parquet
    [PARTITIONED BY] LOCATION path`` from a declared ``StructType``, so the
    catalog states the types instead of inferring them from files.  The database
    must exist (``create_layer``).

    A table that has these columns already, or the first of them, is altered:
    columns are added, then its location is switched in one step.  Only a table of
    other columns or partitions is dropped and made anew.  Sessions that have read
    it before see the new files after ``REFRESH TABLE``.
    """
    fields = {f.name: f.dataType.simpleString() for f in schema.fields}
    if partition_by:                              # Spark puts partition columns last
        fields[partition_by] = fields.pop(partition_by)
    if spark.catalog.tableExists(fqn):
        if _altered(spark, fqn, fields, path, partition_by):
            return fqn
        spark.sql(f"DROP TABLE {_q(fqn)}")
    cols = ", ".join(f"`{c}` {t}" for c, t in fields.items())
    part = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, "false")
    try:
        spark.sql(f"CREATE TABLE {_q(fqn)} ({cols}) USING parquet{part} LOCATION '{_text(path)}'")
    finally:
        spark.conf.set(_PARTITIONS, before)
    return fqn


def _altered(spark: SparkSession, fqn: str, fields: dict[str, str], path: str, partition_by: str | None) -> bool:
    own = spark.catalog.listColumns(fqn)
    parts = [c.name for c in own if c.isPartition]
    plain = [(c.name, c.dataType) for c in own if not c.isPartition]
    wanted = [(c, t) for c, t in fields.items() if c != partition_by]
    same_parts = parts == ([partition_by] if partition_by else []) and all(fields[c.name] == c.dataType for c in own if c.isPartition)
    if not same_parts or wanted[:len(plain)] != plain or table_location(spark, fqn) is None:
        return False
    if wanted[len(plain):]:
        added = ", ".join(f"`{c}` {t}" for c, t in wanted[len(plain):])
        spark.sql(f"ALTER TABLE {_q(fqn)} ADD COLUMNS ({added})")
    spark.sql(f"ALTER TABLE {_q(fqn)} SET LOCATION '{_text(path)}'")
    return True


def create_table_as(spark: SparkSession, fqn: str, select_sql: str,
                    partition_by: str | None = None, location: str | None = None) -> DataFrame:
    """CREATE TABLE .. USING parquet [PARTITIONED BY] [LOCATION] AS SELECT.

    Without ``location`` the table is managed (under the warehouse folder);
    with it the data goes to that path (e.g. shared storage)."""
    part = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    loc = f" LOCATION '{_text(location)}'" if location else ""
    spark.sql(f"DROP TABLE IF EXISTS {_q(fqn)}")
    spark.sql(f"CREATE TABLE {_q(fqn)} USING parquet{part}{loc} AS {select_sql}")
    return spark.table(fqn)


def drop_table(spark: SparkSession, fqn: str, purge: bool = False) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_q(fqn)}{' PURGE' if purge else ''}")


def drop_layer(spark: SparkSession, layer: str, cascade: bool = False) -> bool:
    """Drop the database if it holds no table and its location no file; whether it is
    gone.  ``cascade`` drops its tables first, managed ones with their data; files that
    are no table's stay, and so does the database."""
    if not spark.catalog.databaseExists(layer):
        return True
    if cascade:
        for t in spark.catalog.listTables(layer):
            if not t.isTemporary:
                kind = "VIEW" if t.tableType == "VIEW" else "TABLE"
                spark.sql(f"DROP {kind} IF EXISTS {_q(f'{layer}.{t.name}')}")
    if not is_empty(spark, layer) or _holds_files(spark, layer_location(spark, layer)):
        return False
    spark.sql(f"DROP DATABASE IF EXISTS {_q(layer)} RESTRICT")
    return True


def _holds_files(spark: SparkSession, location: str) -> bool:
    """Whether anything but empty folders lies there."""
    at = _stored_path(spark, location)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(at) and fs.listFiles(at, True).hasNext()


def create_view(spark: SparkSession, name: str, select_sql: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {_q(name)} AS {select_sql}")


def publish_view(spark: SparkSession, fqn: str, select_sql: str) -> None:
    """A persistent view, kept in the catalog for later sessions and replaced in one
    step.  It reads names, so it follows a table that is re-pointed."""
    spark.sql(f"CREATE OR REPLACE VIEW {_q(fqn)} AS {select_sql}")
