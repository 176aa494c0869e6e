"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import work_root

#: Parent of the package, which Python workers need on their path.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Text handed to one round of array work inside a task, in bytes; it bounds a
#: worker's memory and never changes a result.
BATCH_BYTES = 2_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's path (clusters
    ship it with ``--py-files``)."""
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, path) if p)


_scopes: list[list[str]] = []


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Collects the paths of the tables that ``cut`` writes meanwhile."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes[:] = [s for s in _scopes if s is not paths]


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Hadoop's local file system launches a chmod for each folder and file that it makes, one
#: more for a checksum file.  Until its own program begins, a launched process shares all
#: pages of the JVM and reads as large as it, so that an executor seems to hold twice its
#: heap.  Scratch tables do without checksum files (Parquet's pages have their own) and
#: without a marker.  Other file systems don't heed the first two.
PLAIN = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back:
    lineage ends there and every executor sees the files."""
    spark = df.sparkSession
    path = work_root(spark, label)
    for scope in _scopes:
        scope.append(path)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    spark.conf.set(cleanup, "true")  # the written table needs no shuffle files any more
    try:
        df.write.options(**PLAIN).parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in a partition for ``each`` so many of them or for
    each core, unless it has fewer: a small table that follows a shuffle would else be
    stored as a file for each shuffle partition, with the launches told above."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


#: What workers remember between tasks, by operator, and how to forget it.
_remembered: dict[str, Callable[[], Any]] = {}


def remembers(operator: str, forget: Callable[[], Any]) -> None:
    _remembered[operator] = forget


def alone(operator: str | None = None) -> None:
    """Called as a task begins: a worker that served other operators before gives back what
    it remembers for them, so that a pipeline's stages don't pile up in one process."""
    others = [forget for name, forget in _remembered.items() if name != operator]
    for forget in others:
        forget()
    if others:
        gc.collect()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)


def by_bytes(items: Iterable, size=len, limit: int = BATCH_BYTES) -> Iterator[list]:
    """Consecutive items in lists of about ``limit`` bytes, at least one each."""
    part, total = [], 0
    for x in items:
        part.append(x)
        total += size(x)
        if total >= limit:
            yield part
            part, total = [], 0
    if part:
        yield part


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def bucket_of(column, modulus: int):
    """crc32 of the value's decimal text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def let(value, body):
    """``body`` of a value that is worked out once a row.  (The optimiser may copy a
    column's expression into a lambda, which then evaluates it for each element.)"""
    return F.element_at(F.transform(F.array(value), body), 1)


def bounded_sample(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """At most ``rows`` rows of ``df``, by a hash of ``key``: for fitting a model on a
    sample of stated size, never for results."""
    total = df.count()
    if total <= rows:
        return df
    share = F.pmod(F.xxhash64(*key), F.lit(2**32))
    near = df.where(share < int(min(1.0, 1.2 * rows / total) * 2**32))
    return near.orderBy(share, *key).limit(rows)


#: Texts looked at for each one wanted, so that short ones can be preferred.
SPARE = 2


def labelled_sample(docs: DataFrame, known: DataFrame, rows: int, least: int = 0, chars: int | None = None) -> DataFrame:
    """(text, label) rows to fit a model on: about ``rows`` texts, as many of each label
    and at least ``least``, by a hash of the id.

    ``docs`` are (doc_id, text, ..), ``known`` (doc_id, label).  Labels are counted and
    chosen without the texts; the ids chosen, a bounded number, then pick their rows in
    one read of the documents.  With ``chars``, longer texts are taken, as a piece of
    that size at a place by their hash, only where a label has too few shorter ones.
    """
    known = known.where("label is not null")
    share = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(2**32))
    counted = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    each = max(least, -(-rows // max(1, len(counted))))
    below = F.lit(0)
    for label, n in counted.items():
        below = F.when(F.col("label") == F.lit(label), F.lit(int(min(1.0, SPARE * each / n) * 2**32))).otherwise(below)
    if "label" in docs.columns:                     # the documents carry it themselves
        picked = docs.where(share < below).select("doc_id", "text", "label", share.alias("share"))
    else:
        chosen = known.where(share < below).select("doc_id", "label", share.alias("share")).distinct().orderBy(
            "share", "doc_id", "label").limit(2 * SPARE * each * max(1, len(counted)))
        picked = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", "share")
    size, text = F.length("text"), F.col("text")
    long = F.lit(False) if chars is None else size > chars
    if chars is not None:
        start = F.pmod(F.xxhash64("text"), F.greatest(size - chars + 1, F.lit(1))).cast("int") + 1
        text = F.when(long, F.substring("text", start, F.lit(chars))).otherwise(text)
    taken = picked.where("text is not null").select("label", "share", long.alias("long"), text.alias("text"))
    own = Window.partitionBy("label").orderBy("long", "share", "text")
    return taken.withColumn("n", F.row_number().over(own)).where(F.col("n") <= each).select("text", "label")


def labelled_pieces(docs: DataFrame, known: DataFrame, rows: int, least: int, chars: int) -> list[tuple[str, Any]]:
    """The pairs of ``labelled_sample`` on the driver: at most ``rows`` (or ``least`` for
    each label) times ``chars`` characters."""
    return [(r["text"], r["label"]) for r in labelled_sample(docs, known, rows, least, chars).collect()]
