"""The three-layer job: raw -> bronze -> silver -> gold, as stored tables.

Each layer is written (a fresh directory that readers then switch to) before the
next one reads it back, so no plan spans layers, lineage stays short, and a rerun
or a retry after a lost executor starts from finished tables.  Row counts come
from ``Observation``s attached to the writes (no recount scans).

Reruns are safe: every run writes new directories; an interrupted run leaves
only unfinished ones, which nobody reads.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from strata.operators import gold, silver
from strata.schemas import PARTITION_COLUMNS, SOURCE_TABLES
from strata.sinks import catalog
from strata.sinks import tables as T
from strata.sinks.writes import side_by_side, write_table
from strata.sources.delimited import read_delimited, source_path
from strata.sources.tables import read_parquet_table

METRICS_SCHEMA = StructType([
    StructField("phase", StringType(), False),
    StructField("table_name", StringType(), False),
    StructField("row_count", LongType(), True),
    StructField("duration_s", DoubleType(), True),
])


@dataclass
class LayerJob:
    """Configuration of one run.  ``source_format`` is ``text`` (delimited
    raw files ``<source>/<table><suffix>``, e.g. ``orders.csv`` with a header
    or ``orders.tbl`` without one) or ``parquet`` (``<table>.parquet``).

    ``bronze_tasks`` deals raw rows out to so many tasks before they are stored:
    for inputs that Spark can't split (one huge compressed file).  Without it they
    are stored as they are read."""
    source: str
    root: str
    source_format: str = "parquet"
    header: bool = True
    sep: str = "|"
    suffix: str = ".csv"
    tables: tuple[str, ...] = SOURCE_TABLES
    register: bool = False
    audit: bool = True
    parallel: bool = True
    bronze_tasks: int | None = None
    #: One row for each table stored by this run, and where it was stored.
    stored: list[Row] = field(default_factory=list)
    paths: dict[tuple[str, str], str] = field(default_factory=dict)
    #: The order of columns in which each path was written.
    columns: dict[str, list[str]] = field(default_factory=dict)
    #: The databases that this run made.
    made: set[str] = field(default_factory=set)

    # -- storing -------------------------------------------------------------
    def _store(self, spark, layer, table, df) -> None:
        """Store one table.  A failed write leaves an unfinished directory that nobody
        reads, so whoever runs the job again duplicates or half-applies nothing."""
        partition_by = PARTITION_COLUMNS.get((layer, table))
        began = time.monotonic()
        # Whole layers aren't shuffled to be stored: tasks write a file for each year they hold.
        # The few rows of a business table are brought together by year.
        rebalance = layer == "gold" and partition_by is not None
        done = T.publish(spark, self.root, layer, table, df, partition_by, rebalance=rebalance)
        self.paths[layer, table] = done.path
        self.columns[done.path] = df.columns
        seconds = round(time.monotonic() - began, 3)
        self.stored = [r for r in self.stored if (r["phase"], r["table_name"]) != (layer, table)]
        self.stored.append(Row(phase=layer, table_name=table, row_count=done.row_count, duration_s=seconds))

    def _store_layer(self, spark, layer, frames: dict[str, DataFrame]) -> None:
        """Store a layer's tables (independent jobs, submitted together when
        ``parallel``), then register them from this thread."""
        workers = len(frames) if self.parallel else 1
        with side_by_side(spark), ThreadPoolExecutor(max_workers=workers) as pool:
            for job in [pool.submit(self._store, spark, layer, t, df) for t, df in frames.items()]:
                job.result()
        if self.register:
            for table in frames:
                self._declare(spark, layer, table)

    def _declare(self, spark, layer, table) -> None:
        path = self.paths[layer, table]
        if catalog.create_layer(spark, layer, f"{self.root.rstrip('/')}/_catalog"):
            self.made.add(layer)
        catalog.declare_table(spark, f"{layer}.{table}", spark.read.parquet(path).schema, path,
                              PARTITION_COLUMNS.get((layer, table)))

    def register_tables(self, spark: SparkSession) -> None:
        """(Re-)point ``layer.table`` at every table this run stored."""
        for layer, table in self.paths:
            self._declare(spark, layer, table)

    def drop_tables(self, spark: SparkSession, with_data: bool = False) -> None:
        """Take this run's tables out of the catalog, where the names still point at
        them, and the databases that it made, once they hold nothing; ``with_data``
        also deletes the directories this run wrote."""
        for (layer, table), path in self.paths.items():
            if catalog.points_at(spark, f"{layer}.{table}", path):
                catalog.drop_table(spark, f"{layer}.{table}")
            if with_data:
                T.remove_own(spark, path)
        self.made = {layer for layer in self.made if not catalog.drop_layer(spark, layer)}

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        """A table as this run stored it, or else its current content."""
        path = self.paths.get((layer, table)) or T.current_path(spark, self.root, layer, table)
        stored = spark.read.parquet(path)
        return stored.select(self.columns.get(path, stored.columns))

    def metrics(self, spark: SparkSession) -> DataFrame:
        """(phase, table_name, row_count, duration_s) of what this run stored."""
        return spark.createDataFrame(self.stored, METRICS_SCHEMA)

    def row_count(self, layer: str, table: str) -> int:
        return next(r["row_count"] for r in self.stored if (r["phase"], r["table_name"]) == (layer, table))

    def _raw(self, spark, table) -> DataFrame:
        if self.source_format == "text":
            raw = read_delimited(spark, source_path(self.source, table, self.suffix), table,
                                 header=self.header, sep=self.sep)
        else:
            raw = read_parquet_table(spark, self.source, table)
        return raw.repartition(self.bronze_tasks) if self.bronze_tasks else raw

    # -- phases --------------------------------------------------------------
    def bronze(self, spark: SparkSession) -> None:
        self._store_layer(spark, "bronze", {t: self._raw(spark, t) for t in self.tables})

    def silver(self, spark: SparkSession) -> None:
        self._store_layer(spark, "silver", {
            t: silver.clean(self.read(spark, "bronze", t), t, audit=self.audit) for t in self.tables})

    def gold(self, spark: SparkSession) -> None:
        # Both business tables come from the same per-order facts.  They are
        # written once to a staging table under the root (shared storage), which
        # cuts the lineage: a lost executor costs a re-read of staged files, not a
        # recomputation of the join.  Removed once both are stored.
        staging = f"{self.root.rstrip('/')}/staging/order_facts-{uuid.uuid4().hex[:12]}"
        write_table(gold.order_facts(self.read(spark, "silver", "orders"),
                                     self.read(spark, "silver", "lineitem")), staging)
        try:
            facts = spark.read.parquet(staging)
            self._store_layer(spark, "gold", {
                "revenue_by_order_date": gold.revenue_by_order_date(facts),
                "top_customers": gold.top_customers(facts)})
        finally:
            T.remove_own(spark, staging)

    def run(self, spark: SparkSession) -> "LayerJob":
        self.bronze(spark)
        self.silver(spark)
        self.gold(spark)
        return self


def run_layers(spark: SparkSession, source: str, root: str, **options) -> LayerJob:
    return LayerJob(source=source, root=root, **options).run(spark)
