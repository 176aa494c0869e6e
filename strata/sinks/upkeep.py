"""Table upkeep as ordinary Spark jobs: compaction, keyed upsert, copying a warehouse."""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.sinks import tables as T
from strata.sinks.writes import checksum, read_typed, refuse_duplicate_keys, upsert, write_table

SMALL_FILE_BYTES = 64 * 1024 * 1024      # a smaller file is packed together with others
TARGET_FILE_BYTES = 128 * 1024 * 1024    # most bytes of files that are packed into one
MAX_FILES = 20_000                       # small files that one job packs
STAGING = "_compaction-"                 # hidden from readers, as all names with _ are
PLAN = "_plan"


# -- compaction ---------------------------------------------------------------

@dataclass(frozen=True)
class Packed:
    """One rewritten partition (None: the table has none): its files before, and after."""
    value: str | None
    files_before: int
    files_after: int


def table_files(spark: SparkSession, path: str, partition_by: str | None = None) -> DataFrame:
    """(value, file, size) of every file that rows lie in; ``value`` is the partition's,
    as text, as the directory has it.  Only file metadata is read."""
    rows = read_typed(spark, path, partition_by, StringType()) if partition_by else spark.read.parquet(path)
    value = F.col(f"`{partition_by}`") if partition_by else F.lit(None).cast("string")
    return rows.select(value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).groupBy(
        "value", "file").agg(F.first("size").alias("size"))


def partition_files(spark: SparkSession, path: str, partition_by: str | None = None) -> DataFrame:
    """(value, files, bytes) of every partition."""
    return table_files(spark, path, partition_by).groupBy("value").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def first_fit(sizes: dict[str, int], room: int) -> list[list[str]]:
    """Files in bins of at most ``room`` bytes: the largest first, each into the first bin
    that has room for it."""
    bins: list[list[str]] = []
    left: list[int] = []
    first_open = 0
    least = min(sizes.values(), default=0)
    for file, size in sorted(sizes.items(), key=lambda f: (-f[1], f[0])):
        while first_open < len(left) and left[first_open] < least:
            first_open += 1                       # no file fits there any more
        at = next((i for i in range(first_open, len(left)) if left[i] >= size), len(bins))
        if at == len(bins):
            bins.append([])
            left.append(room)
        bins[at].append(file)
        left[at] -= size
    return bins


def compact(spark: SparkSession, path: str, partition_by: str | None = None, *,
            small_file_bytes: int = SMALL_FILE_BYTES, target_file_bytes: int = TARGET_FILE_BYTES,
            max_files: int = MAX_FILES) -> list[Packed]:
    """Pack a table's small files into larger ones, in place; partitioned or not.

    Files under ``small_file_bytes`` are packed, first fit, into bins of
    ``target_file_bytes`` within their partition.  A bin becomes one file, written by one
    task from the bin's files alone; larger files, and a small one that no other fits
    with, are neither read nor renamed.  A job packs at most ``max_files``, whose names
    and sizes are all that reaches the driver; there are as many jobs as it takes.

    New files are written to a hidden folder first, together with a list of the files that
    they stand for.  Then they are moved to their places and the old ones deleted.  A run
    that dies before the list is complete has changed nothing; one that dies later is
    finished by the next ``compact`` of the table, before anything else.  Between the two
    steps a reader that lists the table may see rows twice: compact when nobody reads.
    """
    finish_compaction(spark, path)
    done: list[Packed] = []
    while True:
        packed = _pack_once(spark, path, partition_by, small_file_bytes, target_file_bytes, max_files)
        done += packed
        if not packed:
            return done


def _pack_once(spark, path, partition_by, small_file_bytes, target_file_bytes, max_files) -> list[Packed]:
    files = table_files(spark, path, partition_by).where(F.col("size") < small_file_bytes)
    several = files.groupBy(F.col("value").alias("v")).agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least")).where("n > 1")
    # A file that doesn't even fit with its partition's smallest stays where it is.
    fitting = files.join(several, files["value"].eqNullSafe(several["v"])).where(F.col("size") + F.col("least") <= target_file_bytes)
    chosen: dict = {}
    for r in fitting.select("value", "file", "size").orderBy("value", "size", "file").limit(max_files).collect():
        chosen.setdefault(r["value"], {})[r["file"]] = r["size"]
    bins = [(value, own) for value, sizes in chosen.items() for own in first_fit(sizes, target_file_bytes) if len(own) > 1]
    if not bins:
        return []
    staging = f"{path.rstrip('/')}/{STAGING}{uuid.uuid4().hex[:12]}"
    number = spark.createDataFrame([(f, i) for i, (_, own) in enumerate(bins) for f in own], "file string, bin int")
    rows = read_typed(spark, path, partition_by, StringType()) if partition_by else spark.read.parquet(path)
    own = spark.read.schema(rows.schema).option("basePath", path).parquet(*[unquote(f) for _, files in bins for f in files])
    columns = [F.col(f"`{c}`") for c in own.columns]
    # At most max_files rows are broadcast; a bin's number is its task's.
    dealt = own.select(*columns, F.col("_metadata.file_path").alias("file")).join(F.broadcast(number), "file")
    write_table(dealt.repartitionById(len(bins), "bin").select(*columns), staging, partition_by, mode="error")
    spark.createDataFrame([(f,) for _, files in bins for f in files], "file string").coalesce(1).write.text(f"{staging}/{PLAN}")
    finish_compaction(spark, path)
    before, after = Counter(), Counter(value for value, _ in bins)
    for value, files in bins:
        before[value] += len(files)
    return [Packed(value, before[value], after[value]) for value in after]


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Bring every compaction whose list is complete to its end: move its files into
    place, then delete those that they stand for.  Each step may be repeated."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = jvm.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return
    for folder in [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith(STAGING)]:
        plan = jvm.Path(folder, PLAN)
        if not fs.exists(jvm.Path(plan, "_SUCCESS")):
            continue
        root, found = folder.toString(), fs.listFiles(folder, True)
        while found.hasNext():
            new = found.next().getPath()
            inside = new.toString()[len(root) + 1:]
            if inside.endswith(".parquet"):
                place = jvm.Path(at, inside)
                fs.mkdirs(place.getParent())
                fs.rename(new, place)
        for r in spark.read.text(plan.toString()).collect():          # at most max_files names
            fs.delete(jvm.Path(unquote(r["value"])), False)
        fs.delete(folder, True)


# -- upsert -------------------------------------------------------------------

def upsert_table(spark: SparkSession, root: str, layer: str, table: str, updates: DataFrame,
                 key: str | list[str], partition_by: str | None = None) -> T.Published:
    """Keyed upsert into the whole table, written as its new content.  For large
    tables ``writes.upsert_partitions`` rewrites only what it touches.

    Updates that repeat a key, or whose columns or types are not the table's, are
    refused before anything is written.
    """
    base = T.read_current(spark, root, layer, table)
    refuse_duplicate_keys(updates, key)
    return T.publish(spark, root, layer, table, upsert(base, updates, key), partition_by)


# -- copy a warehouse ---------------------------------------------------------

def copy_tables(spark: SparkSession, src_root: str, dst_root: str,
                partition_by: dict[tuple[str, str], str | None] | None = None) -> DataFrame:
    """Copy every table's current content to a new root as Spark jobs, then compare:
    counts and an order-insensitive row checksum, source against copy."""
    checks = []
    for layer, table in T.tables_under(spark, src_root):
        df = T.read_current(spark, src_root, layer, table)
        T.publish(spark, dst_root, layer, table, df, (partition_by or {}).get((layer, table)))
        both = (checksum(df).withColumn("side", F.lit("source")).unionByName(
            checksum(T.read_current(spark, dst_root, layer, table).select(df.columns)).withColumn("side", F.lit("copy"))))
        src, dst = F.col("side") == "source", F.col("side") == "copy"
        checks.append(both.agg(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"),
            F.max(F.when(src, F.col("row_count"))).alias("source_rows"),
            F.max(F.when(dst, F.col("row_count"))).alias("copied_rows"),
            F.max(F.when(src, F.col("row_hash_sum"))).eqNullSafe(
                F.max(F.when(dst, F.col("row_hash_sum")))).alias("same_rows")))
    if not checks:
        raise ValueError(f"no tables under {src_root}")
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
