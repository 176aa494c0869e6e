"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. Each text's set of distinct five-word shingles (64-bit hashes) gives K minima;
   the low B_BITS of each are kept as packed bit planes, the full minima only as
   one 64-bit key for each band of ROWS minima.
2. Documents with the same set collapse to the smallest id before anything is
   grouped by band.
3. Only buckets that hold several sets go on.  In each, every member is paired with
   one hub: the member that meets most others over all bands, which for a group of
   edited copies is the text they were made from.  The similarity of a pair is
   estimated from the packed planes by bit counts, corrected for chance collisions,
   and unlikely pairs go.
4. The likeliest pair of each document, then its others between different
   components, are confirmed on the full sets of both texts.
5. What is left are buckets that still hold several components.  A bucket is cut into
   blocks of bounded rows and shingles, and each two blocks of it (and each block by
   itself) are a group of their own.  A group's members are compared across
   components by their packed signatures, 64 rows at a time, each pair in the first
   band it shares.  What leaves are the members that have a likely partner, not the
   pairs; with their texts dealt out to the same groups, likely pairs are confirmed
   there on full sets, and only links that join what the group hasn't joined yet leave.

With 44 bands of 5 minima a pair at the threshold of 0.75 is missed with
probability 7e-6, closer pairs with less; the estimate from 1024 minima has a
margin of 4.5 standard deviations (3e-6).

Defined results: texts that are null, empty or without words have no shingles and
link to nothing.  A text of fewer than five words is one shingle.  doc_id is a
document's identity: repeated rows all come back, each with its own set size,
and share one component.  A row with a null doc_id links to nothing, has a null
component and is kept.  Texts of any length are hashed whole; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import alone, cut, few_files, mix64, ready, remove, scratch
from strata.llm.components import components

SHINGLE = 5
BANDS, ROWS = 44, 5
K = 1024                    # minima, of which bands use the first BANDS * ROWS
B_BITS = 2
WORDS64 = K // 64
NEED, OF = 75, 100          # similarity of at least NEED / OF
MARGIN = 0.073              # 4.5 standard deviations of the estimate at 0.75
HOT_MEMBERS = 4096          # a bucket with more, or with more shingles than
HOT_SHINGLES = 4_000_000    # these, is cut into blocks of about so many
WIDE, NARROW = 10_000, 200_000  # rows of a stored file, with texts or signatures and without
GROUP = ("key", "i", "j")   # a bucket and two of its blocks


@lru_cache(maxsize=1)
def _family() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return (rng.integers(0, 2**32, K, dtype=np.uint32) | np.uint32(1),
            rng.integers(0, 2**32, K, dtype=np.uint32),
            rng.integers(0, 2**63, ROWS, dtype=np.uint64) | np.uint64(1))


#: Odd multipliers that tell a word's place in a shingle.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.  Words are split at
    bytes 0x20 and 0x09-0x0D with A-Z in lower case, as ``bytes`` does both."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    total = np.full(n, min(len(words), SHINGLE), np.uint64)
    for j in range(min(len(words), SHINGLE)):
        total += mix64(h[j:j + n] * PLACES[j])
    return np.unique(mix64(total))


def minima(hashes: np.ndarray) -> np.ndarray:
    mul, add, _ = _family()
    low = np.full(K, 2**32 - 1, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 256):
        np.minimum(low, (x[at:at + 256, None] * mul + add).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    _, _, c = _family()
    rows = low[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    return mix64(mix64((rows * c).sum(axis=1, dtype=np.uint64)) + np.arange(BANDS, dtype=np.uint64))


def packed(low: np.ndarray) -> np.ndarray:
    """B_BITS planes of K bits each.  The minima are mixed first: the low bits of
    x * mul + add depend on those of x only, and would agree in all places or none."""
    mixed = mix64(low)
    planes = [np.packbits(((mixed >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)).view(np.int64)
              for b in range(B_BITS)]
    return np.concatenate(planes)


SKETCH = ("doc_id long, n_shingles long, set_hi long, set_lo long, "
          "bands array<long>, planes array<long>")


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    alone()
    for pdf in batches:
        for at in range(0, len(pdf), 512):
            part, rows = pdf.iloc[at:at + 512], []
            for text in part["text"]:
                h = shingle_hashes(text)
                digest = np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), np.int64)
                if len(h):
                    low = minima(h)
                    rows.append((len(h), *digest, band_keys(low).view(np.int64), packed(low)))
                else:
                    rows.append((0, *digest, None, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "set_hi", "set_lo", "bands", "planes"])
            out.insert(0, "doc_id", part["doc_id"].array)
            yield out


def sketch(docs: DataFrame) -> DataFrame:
    ready(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(_sketch, SKETCH)


def estimate(a: str, b: str):
    """Similarity from two packed signatures: the share of positions whose low
    bits agree, corrected for agreement by chance."""
    differ = F.lit(0)
    for w in range(WORDS64):
        words = [F.col(a)[p * WORDS64 + w].bitwiseXOR(F.col(b)[p * WORDS64 + w]) for p in range(B_BITS)]
        any_bit = words[0]
        for x in words[1:]:
            any_bit = any_bit.bitwiseOR(x)
        differ = differ + F.bit_count(any_bit)
    chance = 2.0**-B_BITS
    return ((1 - differ / F.lit(float(K))) - chance) / (1 - chance)


def likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose estimate may reach the threshold, with the estimate."""
    side = reps.select("rep", "planes")
    return (
        pairs.join(side.toDF("a", "planes_a"), "a").join(side.toDF("b", "planes_b"), "b")
        .select("a", "b", estimate("planes_a", "planes_b").alias("est"))
        .where(F.col("est") >= NEED / OF - MARGIN)
    )


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    alone()
    known: tuple = (None, None)
    for pdf in batches:
        keep = []
        for a, b, b_id in zip(pdf["text_a"], pdf["text_b"], pdf["b"]):
            if known[0] != (b_id, b):
                known = (b_id, b), shingle_hashes(b)
            x, y = shingle_hashes(a), known[1]
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both > 0 and OF * both >= NEED * (len(x) + len(y) - both))
        yield pdf.loc[keep, ["a", "b"]]


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets are similar enough.  A text that many pairs
    share stays one row of its side."""
    joined = pairs.select("a", "b").join(texts.toDF("a", "text_a"), "a").join(
        texts.toDF("b", "text_b"), "b")
    return joined.mapInPandas(_confirm, "a long, b long")


def _linked(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(id, component) of the representatives that are linked to another."""
    n = reps.count()
    keys = reps.select("rep", "n_shingles", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut(few_files(keys.join(sizes, "key"), n * BANDS, NARROW), "members")
    need = members.select(F.col("rep").alias("doc_id")).distinct()
    # A merge join at every size: the texts are dealt out once, whatever their number.
    texts = cut(few_files(docs.select("doc_id", "text").join(need.hint("merge"), "doc_id", "left_semi"), n, WIDE), "near-texts")

    met = members.groupBy("rep").agg(F.sum(F.col("size") - 1).alias("met"))
    ranked = members.join(met, "rep").select("key", "rep", F.struct("met", (-F.col("rep")).alias("first")).alias("rank"))
    hubs = ranked.groupBy("key").agg(F.max_by("rep", "rank").alias("hub"))
    stars = members.join(hubs, "key").where("rep <> hub").select(
        F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    found = cut(few_files(likely(stars, reps), n * BANDS, NARROW), "candidates")

    first = found.groupBy("a").agg(F.max_by("b", F.struct("est", -F.col("b"))).alias("b"))
    links = cut(few_files(confirm(first, texts), n, WIDE), "links")
    comps = cut(few_files(components(links, rows=n), n, NARROW), "components")

    # Candidates between components that the first round left apart.
    rest = _across(found.join(first, ["a", "b"], "left_anti").select("a", "b"), comps)
    tried = first.unionByName(first.toDF("b", "a"))
    rest = rest.distinct().join(tried, ["a", "b"], "left_anti")
    more = cut(_cross_component(members, comps, reps, texts).unionByName(confirm(rest, texts)), "links")
    added = more.count()
    return components(links.unionByName(more), rows=n + added) if added else comps


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ..) -> (doc_id, n_shingles, component_id, kept), one row per row."""
    rows = cut(sketch(docs), "sketch")
    reps = cut(few_files(
        rows.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_hi", "set_lo")
        .agg(F.min(F.struct("doc_id", "n_shingles", "bands", "planes")).alias("m"))
        .select("set_hi", "set_lo", F.col("m.doc_id").alias("rep"), "m.n_shingles", "m.bands", "m.planes"),
        rows.count(), WIDE), "sets")

    # Everything between is scratch once the components are a table.
    with scratch() as made:
        comps = cut(few_files(_linked(docs, reps), reps.count(), NARROW), "components")
    remove(docs.sparkSession, made[:-1])

    sets = reps.select("set_hi", "set_lo", "rep").join(
        comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
    ids = sets.select("set_hi", "set_lo", F.coalesce("component", "rep").alias("set_component"))
    out = rows.select("doc_id", "n_shingles", "set_hi", "set_lo").join(ids, ["set_hi", "set_lo"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("set_component", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _labelled(members: DataFrame, comps: DataFrame) -> DataFrame:
    return members.join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "key", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"))


def _across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    a, b = comps.toDF("a", "comp_a"), comps.toDF("b", "comp_b")
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b"))


def _likely_chunks(key: int, component: np.ndarray, bands: np.ndarray, planes: np.ndarray,
                   left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, one of ``left`` and one of ``right`` (both of ``left`` if that is
    None), in different components, whose estimate may reach the threshold; 64 rows
    of ``left`` at a time.  Where ``key`` is a band of theirs, only pairs that share
    none before it, so that a pair leaves from one bucket."""
    chance = 2.0**-B_BITS
    most = int(K * (1 - (NEED / OF - MARGIN) * (1 - chance) - chance))     # positions that may differ
    left = left[np.argsort(component[left], kind="stable")]
    others = left if right is None else right
    far, far_component = np.ascontiguousarray(planes[others].T), component[others]
    place = (bands == key).argmax(axis=1)                                  # 0 where it is none of theirs
    by_band = np.ascontiguousarray(bands.T)
    for at in range(0, len(left), 64):
        rows = left[at:at + 64]
        own = component[rows]
        # Rows lie by component: nothing up to the block's first component's end is new.
        start = int(np.searchsorted(far_component, own[0], side="right")) if right is None else 0
        differ = np.zeros((len(rows), len(others) - start), np.uint16)
        for w in range(WORDS64):
            any_bit = np.zeros(differ.shape, np.uint64)
            for p in range(B_BITS):
                any_bit |= planes[rows, p * WORDS64 + w][:, None] ^ far[p * WORDS64 + w, start:]
            differ += np.bitwise_count(any_bit)
        apart = np.less if right is None else np.not_equal
        x, y = np.nonzero((differ <= most) & apart(own[:, None], far_component[start:]))
        a, b = rows[x], others[y + start]
        until = np.minimum(place[a], place[b])
        for t in range(int(until.max(initial=0))):
            new = (by_band[t, a] != by_band[t, b]) | (t >= until)
            a, b, until = a[new], b[new], until[new]
        if len(a):
            yield a, b


def _likely_pairs(key: int, ids: np.ndarray, component: np.ndarray, bands: np.ndarray,
                  planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All likely pairs of a bucket's members at once, as ids."""
    found = [(np.maximum(ids[a], ids[b]), np.minimum(ids[a], ids[b]))
             for a, b in _likely_chunks(key, component, bands, planes, np.arange(len(ids)), None)]
    return tuple(np.concatenate(v) for v in zip(*found)) if found else (np.empty(0, np.int64),) * 2


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[tuple[slice, tuple]]]]:
    """Rows sorted by (key, i, j), in tables of whole groups, each with the place of
    every group and its arguments of _likely_chunks."""
    held: list[pd.DataFrame] = []

    def whole() -> tuple[pd.DataFrame, list[tuple[slice, tuple]]]:
        rows = pd.concat(held, ignore_index=True)
        at, block = rows[list(GROUP)].to_numpy(), rows["block"].to_numpy()
        component, bands = rows["component"].to_numpy(), np.stack(rows["bands"])
        planes = np.stack(rows["planes"]).view(np.uint64)
        edges = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(rows)]
        groups = []
        for a, z in zip(edges, edges[1:]):
            (key, i, j), own = at[a].tolist(), slice(a, z)
            groups.append((own, (key, component[own], bands[own], planes[own], np.flatnonzero(block[own] == i),
                                 None if i == j else np.flatnonzero(block[own] == j))))
        return rows, groups

    for pdf in batches:
        if not len(pdf):
            continue
        last = (pdf[list(GROUP)] == pdf[list(GROUP)].iloc[-1]).all(axis=1)
        if last.all() and (not held or (held[-1][list(GROUP)].iloc[-1] == pdf[list(GROUP)].iloc[0]).all()):
            held.append(pdf)
            continue
        held.append(pdf[~last])
        yield whole()
        held = [pdf[last]]
    if held:
        yield whole()


def _partnered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The members of each group that have a likely partner there."""
    alone()
    for rows, groups in _groups(batches):
        hit = np.zeros(len(rows), bool)
        for own, sides in groups:
            for a, b in _likely_chunks(*sides):
                hit[own.start + a] = hit[own.start + b] = True
        yield rows.loc[hit, [*GROUP, "block", "rep", "component"]]


def _top(root: dict[int, int], c: int) -> int:
    while (up := root.get(c, c)) != c:
        root[c] = root.get(up, up)
        c = up
    return c


def _links_of_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Likely pairs of each group that are similar enough on full sets, without those
    whose ends the group's links join already."""
    alone()
    for rows, groups in _groups(batches):
        links: list[tuple[int, int]] = []
        for own, sides in groups:
            sets = [shingle_hashes(t) for t in rows["text"].iloc[own]]
            sizes = np.array([len(x) for x in sets])
            ids, component = rows["rep"].iloc[own].tolist(), sides[1].tolist()
            root: dict[int, int] = {}
            for a, b in _likely_chunks(*sides):
                near = OF * np.minimum(sizes[a], sizes[b]) >= NEED * np.maximum(sizes[a], sizes[b])
                for x, y in zip(a[near].tolist(), b[near].tolist()):
                    p, q = _top(root, component[x]), _top(root, component[y])
                    if p == q:
                        continue
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if both > 0 and OF * both >= NEED * (len(sets[x]) + len(sets[y]) - both):
                        root[p] = q
                        links.append((max(ids[x], ids[y]), min(ids[x], ids[y])))
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _blocks(members: DataFrame) -> DataFrame:
    """(key, rep, n_shingles, component) -> (key, i, j, block, rep, component): the
    buckets of several components, each member once for each two blocks that its
    own is one of (i <= j)."""
    several = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).where("low < high").select("key", F.greatest(
        F.ceil(F.col("n") / HOT_MEMBERS), F.ceil(F.col("size") / HOT_SHINGLES)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("rep", F.lit(9)), F.col("blocks")).cast("int")
    dealt = members.join(several, "key").select("key", "rep", "component", "blocks", block.alias("block"))
    return dealt.select("key", "rep", "component", "block", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component")


def _cross_component(members: DataFrame, comps: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a > b) of members that share a bucket but no component yet."""
    grouped = lambda df: df.repartition(*GROUP).sortWithinPartitions(*GROUP)
    signed = reps.select("rep", "bands", "planes")
    buckets = cut(_blocks(_labelled(members, comps)), "buckets")
    near = cut(grouped(buckets.join(signed, "rep")).mapInPandas(
        _partnered, "key long, i int, j int, block int, rep long, component long"), "partnered").distinct()
    return grouped(near.join(signed, "rep").join(texts.toDF("rep", "text"), "rep")).mapInPandas(
        _links_of_groups, "a long, b long")
