"""Session helpers.

The library never builds a session for a caller that already has one; these
helpers exist for tests, the bench and command-line runs.  Scratch output and
lineage cuts go to the shared folder named by ``spark.checkpoint.dir``; only
when that is unset (a bare local test session) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  driver_memory: str | None = None, app: str = "strata",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session used by tests and the bench (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, choosing one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get(CHECKPOINT_KEY, None)
    if not current:
        try:
            current = spark.conf.get(CHECKPOINT_KEY)
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            current = None
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        # A local session has one machine: nothing names a shared folder.
        current = tempfile.mkdtemp(prefix="strata-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def work_root(spark: SparkSession, label: str = "work") -> str:
    """A fresh directory under the shared checkpoint folder for one job."""
    base = ensure_checkpoint_dir(spark)
    return _join(base, "strata", f"{label}-{uuid.uuid4().hex[:12]}")


def _join(base: str, *parts: str) -> str:
    if "://" in base or base.startswith("file:"):
        return "/".join([base.rstrip("/"), *parts])
    return os.path.join(base, *parts)
