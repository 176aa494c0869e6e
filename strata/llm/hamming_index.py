"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

* Codes: a rotation is learned (iterative quantisation: sign codes and the rotation
  that fits them best, by turns) on at most FIT_ROWS vectors; the signs of a
  rotated vector are its code.
* Index: each code is split into PARTS substrings, each with a table of its values.
  Two codes within a Hamming radius r have, by the pigeonhole principle, a
  substring within r // PARTS.  Probing all table values that near, and checking the
  whole codes found, gets every code within r.
* Radius: the smallest that holds RADIUS_SHARE of the true neighbours of the sample's
  own queries; a query that finds fewer codes than asked for probes further out
  until it has them.  What is found is ranked by inner products in double precision.

What the tables save depends on the vectors.  Where neighbours are near (codes within a few
bits), a query meets few values.  The embeddings of the test tables are close to random unit
vectors: the radius that holds their neighbours is 30 of 64 bits, 7 of 16 in a substring,
which most values are within, so there a probe is in effect a scan of the shard's codes by
substring tables, and the floats of about a third are reranked.

Vectors are dealt into shards of about SHARD_ROWS by a hash, queries into blocks of
BLOCK_ROWS, and each task searches one shard for one block; the best of all shards
are merged.  A vector is one row of its shard wherever it lies, so equal or near
vectors gather nowhere.

Defined results: vectors that are null, zero, or hold null or non-finite components
take no part, nor do those of another length than most (the smaller on ties), or
with a null id.  Rows that repeat an id count once, with the smallest vector.  Ties
go to the smaller id.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bounded_sample, cut, ready

FIT_ROWS = 5000
FIT_QUERIES = 500
RADIUS_SHARE = 0.97
PARTS = 4
SHARD_ROWS, BLOCK_ROWS = 16_384, 4096
ROTATION_STEPS = 40
#: Queries probed by one round of array work.
PROBED_AT_ONCE = 32


@dataclass
class Codes:
    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def of(self, x: np.ndarray) -> np.ndarray:
        """Codes as rows of PARTS substrings, or of as many as keep them at 16 bits at most."""
        bits = ((x - self.mean) @ self.rotation >= 0)
        parts = np.array_split(bits, max(PARTS, -(-bits.shape[1] // 16)), axis=1)
        return np.stack([p @ (1 << np.arange(p.shape[1])) for p in parts], axis=1).astype(np.uint32)


def rotate(x: np.ndarray) -> np.ndarray:
    """The rotation whose signs lose least, by alternating steps."""
    rng = np.random.default_rng(3)
    r = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
    for _ in range(ROTATION_STEPS):
        u, _, v = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x)
        r = (u @ v).T
    return r


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of one code to many."""
    return np.bitwise_count(a ^ b).sum(axis=-1)


def fit(x: np.ndarray, k: int) -> Codes:
    """Rotation and radius from a sample of vectors."""
    mean = x.mean(axis=0)
    codes = Codes(mean, rotate(x - mean), 0)
    own = codes.of(x)
    found = []
    for q in range(0, len(x), max(1, len(x) // FIT_QUERIES)):
        s = x @ x[q]
        s[q] = -np.inf
        near = np.argsort(-s, kind="stable")[:min(k, len(x) - 1)]
        found.append(distances(own[q], own[near]))
    codes.radius = int(np.quantile(np.concatenate(found), RADIUS_SHARE, method="higher")) if len(x) > 1 else 0
    return codes


class Index:
    """Substring tables of one shard's codes: the values that occur, and each code's."""

    def __init__(self, codes: np.ndarray):
        self.tables = [np.unique(codes[:, p], return_inverse=True) for p in range(codes.shape[1])]
        self.size = len(codes)

    def within(self, codes: np.ndarray, radius: int) -> np.ndarray:
        """For each of some query codes, which codes lie within ``radius``."""
        probed = np.zeros((len(codes), self.size), bool)
        distance = np.zeros((len(codes), self.size), np.uint16)
        for p, (values, member) in enumerate(self.tables):
            apart = np.bitwise_count(values ^ codes[:, p, None])
            probed |= (apart <= radius // len(self.tables))[:, member]
            distance += apart[:, member]
        return probed & (distance <= radius)


def search(codes: Codes, ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int):
    """The k best of a shard for each query: (query id, id, score)."""
    index, own = Index(codes.of(x)), codes.of(q)
    for at in range(0, len(q), PROBED_AT_ONCE):
        hits = index.within(own[at:at + PROBED_AT_ONCE], codes.radius)
        for i, hit in enumerate(hits, at):
            radius = codes.radius
            while True:
                found = np.flatnonzero(hit)
                found = found[ids[found] != q_ids[i]]
                if len(found) >= k or radius >= x.shape[1]:
                    break
                radius += PARTS
                hit = index.within(own[i:i + 1], radius)[0]
            if len(found) > k:
                rough = x[found] @ q[i]
                found = found[rough >= np.partition(rough, -k)[-k] - 1e-9]
            # Summed alike for every vector, so that equal vectors tie.
            score = (x[found] * q[i]).sum(axis=1)
            best = np.lexsort((ids[found], -score))[:k]
            yield np.full(len(best), q_ids[i]), ids[found][best], score[best]


def _search(codes: Codes, k: int, base: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                          "score": pd.Series(dtype="float64")})
    if not len(base) or not len(queries):
        return empty
    rows = list(search(codes, base["vec_id"].to_numpy(), np.stack(base["vector"]).astype(np.float64),
                       queries["vec_id"].to_numpy(), np.stack(queries["vector"]).astype(np.float64), k))
    return pd.DataFrame({c: np.concatenate([r[i] for r in rows]) for i, c in enumerate(("query_id", "vec_id", "score"))})


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector) of the vectors that take part, one row for each id."""
    v = F.col("vector")
    fine = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                          F.col(vector_column).cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c))
        & F.exists(v, lambda c: c != 0))
    size = fine.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fine.where(F.size("vector") == (size["n"] if size else 0)).groupBy("vec_id").agg(
        F.min("vector").alias("vector"))


def nearest(vectors: DataFrame, queries, k: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The k nearest of all other vectors for the rows that ``queries`` (a condition on
    vec_id) selects: (query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    ready(spark)
    rows = cut(usable(vectors, id_column, vector_column), "vectors")
    total = rows.count()
    sample = bounded_sample(rows, FIT_ROWS, "vec_id").orderBy("vec_id").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    codes = fit(np.array([r["vector"] for r in sample]), k)

    asked = rows.where(queries)
    shards = max(1, -(-total // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    dealt = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = rows.select("vec_id", "vector", dealt(shards, 1).alias("shard"), every(blocks).alias("block"))
    ask = asked.select("vec_id", "vector", every(shards).alias("shard"), dealt(blocks, 2).alias("block"))
    found = base.groupBy("shard", "block").cogroup(ask.groupBy("shard", "block")).applyInPandas(
        partial(_search, codes, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
