"""Scratch tables: their rows come back, and nothing is written beside them."""

from __future__ import annotations

from pathlib import Path

from strata.llm import components
from strata.llm.common import cut, few_files, scratch


def test_scratch_tables_hold_part_files_alone(spark):
    rows = [(1, "a"), (1, "a"), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    with scratch() as made:
        full, empty = cut(df, "scratch"), cut(df.where("doc_id > 9"), "scratch")
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted(map(tuple, full.collect()), key=key) == sorted(rows, key=key)
    assert empty.collect() == [] and empty.schema == df.schema
    # Every further file is a process that the local file system launches from an executor.
    left = [f.name for p in made for f in Path(p.removeprefix("file://").removeprefix("file:")).rglob("*")]
    assert left and all(f.startswith("part-") for f in left), left


def test_small_tables_after_a_shuffle_are_few_files(spark, monkeypatch):
    """Each file costs launched processes, so a round of components isn't a file for each shuffle partition."""
    monkeypatch.setattr(components, "remove", lambda *_: None)
    most = spark.sparkContext.defaultParallelism
    keys = {"spark.sql.shuffle.partitions": str(most + 8), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    edges = spark.range(3, 600).selectExpr("id as a", "id - 3 as b")
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        with scratch() as rounds:
            found = components.components(edges, rows=597).collect()
        assert few_files(edges.distinct(), 597, 10).rdd.getNumPartitions() <= max(most, 60)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, found)) == [(i, i % 3) for i in range(600)]
    files = lambda p: len(list(Path(p.removeprefix("file://").removeprefix("file:")).glob("part-*")))
    assert len(rounds) > 2 and all(files(p) <= most for p in rounds)
