"""Connected components of an edge table, in rounds of ordinary joins.

Alternating large and small stars (Kiveris et al., 2014): each round every node
hands its smallest neighbour to the others, so the edges turn into stars around
the smallest id of each component.  A round's edges are a table in the shared
checkpoint folder; only two sums a round reach the driver.  No neighbour list is
collected, so a component or a node of any degree is only more rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, few_files, remove, scratch

#: Edges in a stored file.
EACH = 200_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours (larger ones, or the others and itself) to the
    smallest of its neighbourhood."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.unionByName(back) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    out = both.join(least, "a")
    if large:
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, label: str = "components", rows: int | None = None) -> DataFrame:
    """Undirected edges (a long, b long) -> (id, component) for every id that has
    an edge to another; component is the smallest id reachable.  Null ends and
    loops link nothing.  ``rows``: at most so many edges, where the caller knows."""
    with scratch() as before:
        edges = edges.where("a <> b").select("a", "b").distinct()
        edges = cut(edges if rows is None else few_files(edges, rows, EACH), label)
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(
            F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or state["n"] == 0:
            break
        seen = state
        with scratch() as made:
            # A large star has no more edges than before, a small one a further for each node.
            edges = cut(few_files(_star(_star(edges, large=True), large=False), 2 * state["n"], EACH), label)
        remove(edges.sparkSession, before)
        before = made
    return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
