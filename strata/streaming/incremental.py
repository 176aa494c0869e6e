"""Incremental raw ingest ("process only files not seen before").

Structured Streaming's file source remembers, in its checkpoint, which raw
files it has already read; the file sink records committed output files in
its ``_spark_metadata`` log, and batch readers of the sink directory see only
committed files.  Run with ``trigger(availableNow=True)`` it behaves like a
batch job that picks up exactly the new raw files since the last run — what
a managed platform's job bookmarks provide — with exactly-once output even
when executors are lost or the run is repeated.

The clean layer is row-at-a-time (types, derived columns, key gate), so it
streams the same way from the bronze directory; the business layer needs the
whole history per date/customer and stays a batch recompute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from strata.operators import silver
from strata.schemas import PARTITION_COLUMNS, raw_schema


#: How much older than the newest file seen a raw file may be and still be read.  The
#: file source forgets file names beyond it, and would pass over older ones without
#: a word; a century is beyond any delivery delay, at the price of remembering every
#: name in the checkpoint.
MAX_FILE_AGE = "36500d"


def raw_stream(spark: SparkSession, raw_dir: str, table: str, *, header: bool = True,
               sep: str = "|", columns: list[str] | None = None,
               max_files_per_trigger: int | None = None, recursive: bool = False
               ) -> DataFrame:
    """Streaming read of delimited raw files under the declared schema;
    ``recursive`` also reads files in sub-directories (one per delivery)."""
    reader = (spark.readStream.schema(raw_schema(table, columns))
              .option("header", "true" if header else "false")
              .option("sep", sep).option("mode", "PERMISSIVE")
              .option("maxFileAge", MAX_FILE_AGE))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(raw_dir)


def _stored_rows(df: DataFrame, path: str) -> int:
    """Rows that readers of a sink's folder see; 0 before its first run."""
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return 0
    return spark.read.schema(df.schema).parquet(path).agg(F.count(F.lit(1))).first()[0]


def _run_available_now(df: DataFrame, path: str, checkpoint: str,
                       partition_by: str | None = None) -> int:
    """Run until nothing new is left; returns the rows added, counted in the sink
    (file footers only).  The query's own progress keeps but its last batches."""
    before = _stored_rows(df, path)
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    q = writer.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return _stored_rows(df, path) - before


def ingest_new_files(spark: SparkSession, raw_dir: str, table: str, bronze_path: str,
                     checkpoint: str, **options) -> int:
    """Append the raw files that arrived since the last run to the bronze
    directory; returns the rows added by this run (0 when nothing is new)."""
    return _run_available_now(raw_stream(spark, raw_dir, table, **options),
                              bronze_path, checkpoint)


def clean_new_rows(spark: SparkSession, bronze_path: str, table: str, silver_path: str,
                   checkpoint: str) -> int:
    """Type, derive and gate the bronze rows not yet cleaned; append them to
    the year-partitioned silver directory."""
    schema = spark.read.parquet(bronze_path).schema
    stream = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE).parquet(bronze_path)
    cleaned = silver.clean(stream, table)
    return _run_available_now(cleaned, silver_path, checkpoint,
                              PARTITION_COLUMNS[("silver", table)])
