"""Ranked lexical search for many items at once, with shared partial sums.

1. Items are read in blocks of about BLOCK_BYTES of text.  The terms of a block are its
   vocabulary; one pass over the documents counts them, and all terms, of each document.
2. Corpus statistics (documents with a term, all terms, documents of each term) are
   Spark aggregates over all documents; those of a block's terms reach the driver.
3. Common subexpressions: the pair of terms (or of sets found before) that most items
   share becomes a new node, and takes the pair's place in these items; this goes on while
   any pair is shared by two items.  What comes out is a directed acyclic graph: terms,
   sets that several items share, and for each item the nodes that make it up.
4. For a batch of documents a node's scores are the sum of its two parts', worked out once,
   level by level; an item's scores add its nodes.  All sums are 64-bit integers.
5. A task keeps the best LIMIT documents of each item; the tasks' are merged in two
   steps, the first of them dealt out by document.

A document's work depends on its block's graph only, and a task holds CELLS numbers at
once; an item however common its terms gathers nothing but its best documents.

Defined results: a null or empty text has no terms; documents without terms are in no
count.  Items without terms, or with a null item_id, return nothing; rows that repeat an
item_id are one item with the terms of all of them.  Rows that repeat a doc_id are
documents of their own; those with a null doc_id count in the statistics and aren't
returned.  Texts are processed whole; empty tables give no rows; other columns are not
read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import by_bytes, cut, ready

LIMIT = 10
#: Text of the items that one pass over the documents serves.
BLOCK_BYTES = 1_000_000
#: Nodes of one item among which pairs are looked for (the most shared ones).
MINED_NODES = 256
#: Numbers held by one round of scoring.
CELLS = 4_000_000
#: First-step groups of the merge.
MERGE_GROUPS = 64

def _table() -> bytes:
    """Bytes between terms as spaces, A-Z in lower case."""
    table = bytearray(range(256))
    for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        table[low:high + 1] = b" " * (high + 1 - low)
    table[0x41:0x5B] = range(0x61, 0x7B)
    return bytes(table)


TABLE = _table()


def terms_of(text: str | None) -> list[bytes]:
    """Runs of 0-9, A-Z, a-z and characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode().translate(TABLE).split()


# -- the query-sharing graph -------------------------------------------------------

@dataclass
class Graph:
    """``leaves``: (term, times) of the first nodes; ``parts``: the two nodes of each
    further one, after both; ``levels``: those nodes in rounds that need only earlier
    ones; ``items``: the nodes that make up each item."""
    leaves: list[tuple[int, int]]
    parts: list[tuple[int, int]]
    levels: list[np.ndarray]
    items: list[list[int]]

    def additions(self) -> int:
        """Sums for each document."""
        return len(self.parts) + sum(len(i) - 1 for i in self.items)


def share(items: list[Counter]) -> Graph:
    """The graph of items given as term -> times."""
    number: dict[tuple[int, int], int] = {}
    for item in items:
        for leaf in sorted(item.items()):
            number.setdefault(leaf, len(number))
    own = [{number[leaf] for leaf in item.items()} for item in items]
    users: list[set[int]] = [set() for _ in number]
    for i, nodes in enumerate(own):
        for x in nodes:
            users[x].add(i)

    shared: Counter = Counter()
    for nodes in own:
        often = sorted((x for x in nodes if len(users[x]) > 1), key=lambda x: (-len(users[x]), x))[:MINED_NODES]
        shared.update(combinations(sorted(often), 2))
    queue = [(-n, pair) for pair, n in shared.items() if n > 1]
    heapq.heapify(queue)
    parts: list[tuple[int, int]] = []
    while queue:
        n, (a, b) = heapq.heappop(queue)
        both = users[a] & users[b]
        if len(both) < 2:
            continue
        if len(both) < -n:                       # some items use them otherwise by now
            heapq.heappush(queue, (-len(both), (a, b)))
            continue
        node = len(users)
        parts.append((a, b))
        users.append(both)
        users[a], users[b] = users[a] - both, users[b] - both
        beside: Counter = Counter()
        for i in both:
            own[i] -= {a, b}
            beside.update(own[i])
            own[i].add(node)
        for x, n in beside.items():
            if n > 1:
                heapq.heappush(queue, (-n, (x, node)))

    depth = [0] * len(number)
    for a, b in parts:
        depth.append(1 + max(depth[a], depth[b]))
    at = np.array(depth, np.int64)
    levels = [np.flatnonzero(at == d) for d in range(1, max(depth, default=0) + 1)]
    return Graph(list(number), parts, levels, [sorted(nodes) for nodes in own])


# -- counting ----------------------------------------------------------------------

COUNTED = "doc_id long, n long, terms array<int>, times array<int>"


def _count(vocabulary: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = vocabulary.value.get
    for batch in batches:
        ids, at = batch.column("doc_id").cast(pa.int64()), 0
        for part in by_bytes(batch.column("text").to_pylist(), size=lambda t: len(t or "")):
            n, sizes, terms, times = [], [0], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for text in part:
                own = terms_of(text)
                n.append(len(own))
                found, often = np.unique(np.array([t for t in map(known, own) if t is not None], np.int64), return_counts=True)
                terms.append(found)
                times.append(often)
                sizes.append(len(found))
            offsets = np.cumsum(sizes).astype(np.int32)
            listed = lambda v: pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(v).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([ids[at:at + len(part)], pa.array(n, pa.int64()), listed(terms), listed(times)],
                                             names=["doc_id", "n", "terms", "times"])
            at += len(part)


def weight(documents: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * with_term + 1)))


# -- scoring -----------------------------------------------------------------------

@dataclass
class Scorer:
    graph: Graph
    item_ids: list
    weights: np.ndarray          # of each term of the vocabulary
    documents: int               # N
    length: int                  # L

    def __post_init__(self):
        self.term = np.array([t for t, _ in self.graph.leaves], np.int64)
        self.repeat = np.array([n for _, n in self.graph.leaves], np.int64)[:, None]
        self.parts = np.array(self.graph.parts, np.int64).reshape(-1, 2)
        self.nodes = np.array([x for nodes in self.graph.items for x in nodes], np.int64)
        sizes = [len(nodes) for nodes in self.graph.items]
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        rows = len(self.weights) + len(self.term) + len(self.parts) + len(self.nodes) + len(sizes)
        self.at_once = max(16, CELLS // rows)

    def scores(self, n: np.ndarray, offsets: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Items x documents.  Document k has the terms of offsets[k]:offsets[k + 1]."""
        m = 100 - 75 + (75 * n * self.documents) // self.length
        doc = np.repeat(np.arange(len(n)), np.diff(offsets))
        base = np.zeros((len(self.weights), len(n)), np.int64)
        base[terms, doc] = self.weights[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * m[doc]))
        first = len(self.term)
        sums = np.empty((first + len(self.parts), len(n)), np.int64)
        sums[:first] = base[self.term] * self.repeat
        for level in self.graph.levels:
            a, b = self.parts[level - first].T
            sums[level] = sums[a] + sums[b]
        return np.add.reduceat(sums[self.nodes], self.starts, axis=0)


class Best:
    """The best documents of each item so far, as rows by (item, -score, id)."""

    def __init__(self, items: int, limit: int):
        self.limit, self.least = limit, np.ones(items, np.int64)
        self.item, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        item, score, own = (np.concatenate(v) for v in (
            (self.item, item), (self.score, scores[item, doc]), (self.id, ids[doc])))
        order = np.lexsort((own, -score, item))
        item, score, own = item[order], score[order], own[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = rank < self.limit
        self.item, self.score, self.id = item[kept], score[kept], own[kept]
        full = rank[kept] == self.limit - 1
        self.least[self.item[full]] = self.score[full]


def _search(scorer: Broadcast, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = scorer.value
    best = Best(len(own.item_ids), limit)
    for batch in batches:
        for at in range(0, batch.num_rows, own.at_once):
            part = batch.slice(at, own.at_once)
            terms, times = part.column("terms"), part.column("times")
            offsets = terms.offsets.to_numpy()
            long = lambda c: c.to_numpy(zero_copy_only=False).astype(np.int64)
            best.add(long(part.column("doc_id")), own.scores(
                long(part.column("n")), offsets, long(terms.flatten()), long(times.flatten())))
    yield pa.RecordBatch.from_arrays(
        [pa.array(best.item, pa.int32()), pa.array(best.id, pa.int64()), pa.array(best.score, pa.int64())],
        names=["item", "doc_id", "score"])


def _ranked(found: DataFrame, limit: int, *groups: str) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def _block(docs: DataFrame, items: DataFrame, limit: int) -> DataFrame | None:
    spark = docs.sparkSession
    texts: dict = {}
    for r in items.collect():
        texts.setdefault(r["item_id"], Counter()).update(terms_of(r["text"]))
    texts = {i: c for i, c in sorted(texts.items()) if c}
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*texts.values())))}
    if not vocabulary:
        return None
    counted = cut(docs.select("doc_id", "text").mapInArrow(
        partial(_count, spark.sparkContext.broadcast(vocabulary)), COUNTED).where("n > 0"), "term-counts")
    total = counted.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    if not total["N"]:
        return None
    with_term = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        with_term[r["term"]] = r["count"]
    scorer = Scorer(
        share([Counter({vocabulary[t]: n for t, n in c.items()}) for c in texts.values()]), list(texts),
        np.array([weight(total["N"], int(n)) for n in with_term], np.int64), total["N"], total["L"])
    found = counted.where("doc_id is not null and size(terms) > 0").mapInArrow(
        partial(_search, spark.sparkContext.broadcast(scorer), limit), "item int, doc_id long, score long")
    merged = _ranked(found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_GROUPS))), limit, "item", "part")
    ids = spark.createDataFrame(list(enumerate(scorer.item_ids)), f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
    return _ranked(merged.drop("rank"), limit, "item").join(ids, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, text) and (item_id, text) -> item_id, rank, doc_id, score: the ``limit``
    best documents of each item with a score above 0."""
    ready(docs.sparkSession)
    rows = items.where("item_id is not null").select("item_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    own = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = [b for b in (_block(docs, rows.where(own == n), limit) for n in range(blocks)) if b is not None]
    if not found:
        return rows.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                           F.lit(0).cast("long").alias("score")).where(F.lit(False))
    out = found[0]
    for block in found[1:]:
        out = out.unionByName(block)
    return out
