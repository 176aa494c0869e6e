"""SimHash near-duplicates against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL

from strata.llm import simhash_dedup
from strata.llm.common import read
from strata.llm.queries import QUERIES


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(codes):
    """Smallest id reachable over codes within four bits: ids are places."""
    at = list(range(len(codes)))
    for a, x in enumerate(codes):
        for b in np.flatnonzero(np.bitwise_count(codes[a + 1:] ^ x) <= 4) + a + 1:
            if at[a] != at[b]:
                low, high = sorted((at[a], at[b]))
                at = [low if c == high else c for c in at]
    return at


def spread_codes(rng, groups, copies, bits):
    """Codes in chains of small steps, near others or not."""
    codes = []
    for _ in range(groups):
        x = rng.getrandbits(64)
        for _ in range(copies):
            codes.append(x)
            for b in rng.sample(range(64), rng.randrange(bits + 1)):
                x ^= 1 << b
    rng.shuffle(codes)
    return np.array(codes, np.uint64)


def test_variants_meet_within_four_bits(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    near = [base]
    for n in (1, 2, 3, 4) * 20:
        x = base
        for b in rng.sample(range(64), n):
            x ^= 1 << b
        near.append(x)
    signed = [int(np.uint64(x).view(np.int64)) for x in dict.fromkeys(near)]
    rows = simhash_dedup.variants(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    assert len(rows) == 64 * len(signed)
    own = {}
    for r in rows:
        own.setdefault(r["fp"], set()).add(r["key"])
    assert all(own[x] & own[signed[0]] for x in signed)


@pytest.mark.parametrize("hot", [4096, 20])
def test_linked_codes(spark, monkeypatch, hot):
    """Blocks of hot variants change nothing but the search."""
    monkeypatch.setattr(simhash_dedup, "HOT_ROWS", hot)
    rng = random.Random(5)
    codes = np.unique(np.concatenate([
        spread_codes(rng, 20, 12, 5), spread_codes(rng, 1, 150, 3),
        # One value of the upper two segments: hot, mostly not linked.
        np.array([7 << 22 | rng.getrandbits(22) for _ in range(150)], np.uint64)]).view(np.int64))
    got = {r["id"]: r["component"] for r in simhash_dedup.linked_codes(
        spark.createDataFrame([(int(c),) for c in codes], "fp long")).collect()}
    want = plain_components(codes.view(np.uint64))
    assert len(set(want)) < len(want)
    assert {int(c): got.get(int(c), int(c)) for c in codes} == {int(c): int(codes[w]) for c, w in zip(codes, want)}


def test_spanning_links_are_few():
    codes = np.unique(spread_codes(random.Random(3), 3, 400, 3))
    links = [pair for a, b in simhash_dedup.spanning_links(codes, np.arange(len(codes))) for pair in zip(a, b)]
    assert len(links) == len(codes) - len(set(plain_components(codes)))
    assert all(np.bitwise_count(codes[a] ^ codes[b]) <= 4 for a, b in links)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in read(spark, SF_SMALL, "documents").collect()}
    ids = sorted(texts)
    codes = np.array([plain_fingerprint(texts[i]) for i in ids], np.uint64)
    component = plain_components(codes)
    got = {tuple(r) for r in QUERIES["op13_simhash_dedup"](spark, SF_SMALL).collect()}
    assert got == {(i, f"{int(c):016x}", ids[k]) for i, c, k in zip(ids, codes, component)}


def test_edges(spark):
    same = "one two three four five six"
    rows = [(5, None), (3, ""), (4, " \n\t"), (9, same), (2, same.upper()), (2, same), (None, same), (None, None), (7, "x"),
            (8, " ".join(f"w{i}" for i in range(200_000)))]
    docs = spark.createDataFrame([(i, t, 1, 2, "c", 3) for i, t in rows],
                                 "doc_id long, text string, fp long, key long, component string, rep long")
    got = sorted(map(tuple, simhash_dedup.near_duplicates(docs).collect()), key=repr)
    code = lambda t: f"{plain_fingerprint(t):016x}"
    assert got == sorted([(5, "0" * 16, 3), (3, "0" * 16, 3), (4, "0" * 16, 3), (9, code(same), 2), (2, code(same), 2), (2, code(same), 2),
                          (None, code(same), None), (None, "0" * 16, None), (7, code("x"), 7), (8, code(rows[-1][1]), 8)], key=repr)
    assert simhash_dedup.near_duplicates(docs.limit(0)).collect() == []
