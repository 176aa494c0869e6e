"""Shared partial sums against plain sums for each item and document."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import shared_ranking
from strata.llm.shared_ranking import Best, Scorer, search, share


def plain(docs, items, limit=10):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    counts = [(i, Counter(split(t)), len(split(t))) for i, t in docs]
    total, length = sum(n > 0 for *_, n in counts), sum(n for *_, n in counts)
    held = Counter(t for _, c, _ in counts for t in c)
    wanted: dict = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, Counter()).update(split(t))
    out = []
    for i, own in wanted.items():
        scored = []
        for d, c, n in counts:
            score = sum(times * shared_ranking.weight(total, held[t]) * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * total // length)))
                        for t, times in own.items() if t in c)
            if score > 0 and d is not None:
                scored.append((-score, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:limit], 1)]
    return sorted(out)


def random_items(rng, n, vocabulary):
    return [Counter(rng.choices(range(vocabulary), [1 / (k + 1) for k in range(vocabulary)], k=rng.randrange(1, 40))) for _ in range(n)]


def unfolded(graph, node):
    if node < len(graph.leaves):
        term, times = graph.leaves[node]
        return Counter({term: times})
    a, b = graph.parts[node - len(graph.leaves)]
    return unfolded(graph, a) + unfolded(graph, b)


def test_graph_is_the_items():
    rng = random.Random(6)
    items = random_items(rng, 60, 120)
    items += [items[3], items[3], Counter({500: 2})]
    graph = share(items)
    assert [sum((unfolded(graph, x) for x in nodes), Counter()) for nodes in graph.items] == items
    assert graph.additions() < 0.7 * sum(len(i) - 1 for i in items)
    assert graph.items[3] == graph.items[-2] and len(graph.items[3]) == 1          # a whole item is shared
    assert sorted(x for level in graph.levels for x in level) == list(range(len(graph.leaves), len(graph.leaves) + len(graph.parts)))
    below = lambda x: {x}.union(*(below(p) for p in graph.parts[x - len(graph.leaves)])) if x >= len(graph.leaves) else {x}
    users = Counter(n for nodes in graph.items for n in set().union(*map(below, nodes)))
    assert all(users[n] > 1 for n in range(len(graph.leaves), len(graph.leaves) + len(graph.parts)))


def test_scores_are_plain_sums():
    rng = random.Random(8)
    items, terms = random_items(rng, 30, 60), 60
    weights = np.array([rng.randrange(0, 20_000) for _ in range(terms)])
    scorer = Scorer(share(items), list(range(30)), weights, 1000, 300_000)
    docs = [Counter(rng.choices(range(terms), k=rng.randrange(0, 50))) for _ in range(40)]
    n = np.array([max(1, sum(d.values()) * 7) for d in docs])
    rows = [sorted(d.items()) for d in docs]
    got = scorer.scores(n, np.cumsum([0] + [len(r) for r in rows]), np.array([t for r in rows for t, _ in r]), np.array([x for r in rows for _, x in r]))
    for i, item in enumerate(items):
        for k, d in enumerate(docs):
            m = 25 + 75 * int(n[k]) * 1000 // 300_000
            assert got[i, k] == sum(times * int(weights[t]) * (10**9 * d[t] // (1000 * d[t] + 8 * m)) for t, times in item.items() if t in d)


def test_best_keeps_ties_by_id():
    rng = np.random.default_rng(1)
    ids, scores = rng.permutation(400), rng.integers(0, 6, (5, 400))
    best = Best(5, 7)
    for at in range(0, 400, 33):
        best.add(ids[at:at + 33], scores[:, at:at + 33])
    for i in range(5):
        want = sorted((-s, d) for s, d in zip(scores[i], ids) if s > 0)[:7]
        assert [(-s, d) for s, d in zip(best.score[best.item == i], best.id[best.item == i])] == want


def corpus(rng):
    words = [f"W{i}" for i in range(80)] + ["É", "中文", "x9"]
    text = lambda k: "-".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=k))
    docs = [(i * 7 % 301, text(rng.randrange(1, 60))) for i in range(300)]
    items = [(i, text(rng.randrange(1, 25))) for i in range(25)]
    return docs + [(400, docs[0][1]), (401, docs[0][1])], items + [(30, items[0][1] + " " + items[0][1]), (31, items[0][1])]


@pytest.mark.parametrize("block, cells", [(1_000_000, 4_000_000), (200, 3000)])
def test_search(spark, monkeypatch, block, cells):
    """Blocks of items and rounds of documents change nothing."""
    monkeypatch.setattr(shared_ranking, "BLOCK_BYTES", block)
    monkeypatch.setattr(shared_ranking, "CELLS", cells)
    docs, items = corpus(random.Random(9))
    got = search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == plain(docs, items)


def test_edges(spark):
    long = "alpha " * 100_000 + "beta"
    docs = [(1, "Alpha beta"), (2, "alpha BETA"), (2, "alpha beta gamma"), (None, "gamma"), (None, None), (3, None), (4, ""), (5, "!? --"), (6, long)]
    items = [(1, "beta!alpha"), (2, None), (3, ""), (4, "nowhere"), (5, "gamma"), (5, "beta beta"), (None, "alpha"), (6, long)]
    table = spark.createDataFrame([(i, t, 1, 2, 3, "r") for i, t in docs], "doc_id long, text string, n int, item int, score int, rank string")
    asked = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id int, text string, doc_id int")
    got = search(table, asked)
    assert sorted(map(tuple, got.collect())) == plain(docs, items)
    assert dict(got.dtypes) == {"item_id": "int", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    for empty in (search(table.limit(0), asked), search(table, asked.limit(0)), search(table.where("doc_id = 3"), asked)):
        assert empty.collect() == [] and empty.dtypes == got.dtypes
