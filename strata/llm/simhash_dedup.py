"""Near-duplicate documents by SimHash, found through deletion-variant signatures.

1. A text's four-word shingles (repeats included) are hashed to 64 bits; a bit of the
   fingerprint is 1 if it is set in over half of the hashes.  Documents with the same
   fingerprint collapse to one row before anything else is shuffled.
2. Codes that differ in at most DISTANCE = 4 bits are cut into 3 segments, so that one
   of them differs by at most one bit.  Each segment is indexed under its one-wildcard
   variants: the segment with one bit left out, for every bit (64 rows a fingerprint).
   Two segments at most one bit apart have a variant in common.
3. Fingerprints that share a variant meet in a task, by equality of the variant, and
   their whole codes are compared there.  What leaves is links only: a row that is linked
   leaves the search at once, so that a large group of n near copies gives n - 1 links,
   not all its pairs.  Equal segments meet under each of their variants, and are linked
   under the first.
4. Variants are counted before that, and one with more than HOT_ROWS fingerprints is dealt
   into blocks.  First each block is searched by itself; then, where a variant's blocks
   still hold several components, each two blocks are searched across components.  No
   pair is left out.
5. The links' connected components are labelled with their smallest doc_id.

The index costs 64 rows of 20 bytes for each distinct fingerprint, in two shuffles.  Two
unrelated fingerprints share a variant with probability 64 / 2**20, so comparisons grow
with the square of the distinct fingerprints at a rate of 1 in 16,000; each is one machine
operation on a word inside a task, and leaves no row.

Defined results: texts that are null, empty or without words have fingerprint zero, which
links like any other; fewer than four words are one shingle.  Repeated rows all come back.
A row with a null doc_id gets its fingerprint, a null component, and links nothing.  Texts
are processed whole, in bounded pieces; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, ready, remove, scratch
from strata.llm.components import components

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Offset and width of each segment of the 64 bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of one variant that one task compares with each other.
HOT_ROWS = 4096
#: Fingerprints whose variants one task makes.
CODES_A_TASK = 50_000
#: Variants of at most so many rows are compared all together, by shifts.
SMALL = 16
#: Hashes turned into bits, and rows compared with others, by one round of array work.
HASHES_AT_ONCE, ROWS_AT_ONCE = 65_536, 64


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 of each shingle.  Words are split at bytes 0x20 and 0x09-0x0D with A-Z in
    lower case, as ``bytes`` does both."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    spans = map(slice, (end - length)[:n].tolist(), end[-n:].tolist())
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), repeat(SEED)), np.uint64, n)


def fingerprint(text: str | None) -> int:
    """The SimHash of a text, as a signed 64-bit number."""
    h = shingle_hashes(text).astype(">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), HASHES_AT_ONCE):
        ones += np.unpackbits(h[at:at + HASHES_AT_ONCE].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf[["doc_id"]].assign(fp=np.fromiter(map(fingerprint, pdf["text"]), np.int64, len(pdf)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp), one pass."""
    ready(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(_fingerprints, "doc_id long, fp long")


# -- deletion variants ---------------------------------------------------------

def _variant(segment: int, bit: int) -> Column:
    """A segment's value without one bit, marked with both places."""
    offset, width = SEGMENTS[segment]
    kept = (1 << width) - 1 & ~(1 << bit)
    return F.shiftrightunsigned("fp", offset).bitwiseAND(F.lit(kept)).bitwiseOR(F.lit((segment << 5 | bit) << 22))


def variants(codes: DataFrame) -> DataFrame:
    """(fp) -> (key, fp): every one-wildcard variant of every segment."""
    return codes.select(F.explode(F.array(*[
        _variant(s, b) for s, (_, width) in enumerate(SEGMENTS) for b in range(width)])).alias("key"), "fp")


def _hot(rows: DataFrame) -> DataFrame:
    """(key, blocks) of the variants that are dealt into blocks.  There is at most one
    for each HOT_ROWS rows; Spark measures the table before it broadcasts it."""
    return cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS).select(
        "key", F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("blocks")), "hot-variants")


def _block() -> Column:
    return F.pmod(F.xxhash64("fp", F.lit(9)), F.col("blocks")).cast("int")


def _dealt_out(codes: DataFrame) -> DataFrame:
    """The same rows in parts whose variants are worth a task each."""
    parts = max(codes.sparkSession.sparkContext.defaultParallelism, -(-codes.count() // CODES_A_TASK))
    return codes.repartition(parts, "fp")


# -- equality join and verification ---------------------------------------------

def spanning_links(codes: np.ndarray, component: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b) of codes within DISTANCE that, together, join what can be joined
    between components, each component once.  Rows that have been reached are compared
    with those that haven't, and only with them."""
    left = np.arange(len(codes))
    while len(left):
        own = component[left] == component[left[0]]
        todo, left = left[own], left[~own]
        while len(todo) and len(left):
            rows, todo = todo[:ROWS_AT_ONCE], todo[ROWS_AT_ONCE:]
            near = np.bitwise_count(codes[rows, None] ^ codes[left]) <= DISTANCE
            hit = np.flatnonzero(near.any(axis=0))
            if not len(hit):
                continue
            reached, first = np.unique(component[left[hit]], return_index=True)
            hit = hit[first]
            yield rows[near[:, hit].argmax(axis=0)], left[hit]
            new = np.isin(component[left], reached)
            todo, left = np.concatenate([todo, left[new]]), left[~new]


def _runs(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows sorted by ``by`` in tables of whole groups, with the groups' edges."""
    held: list[pd.DataFrame] = []

    def whole():
        rows = pd.concat(held, ignore_index=True)
        at = rows[by].to_numpy()
        return rows, np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1, [len(rows)]])

    for pdf in batches:
        if not len(pdf):
            continue
        last = (pdf[by].to_numpy() == pdf[by].iloc[-1].to_numpy()).all(axis=1)
        if last.all() and (not held or (held[-1][by].iloc[-1] == pdf[by].iloc[0]).all()):
            held.append(pdf)
            continue
        held.append(pdf[~last])
        yield whole()
        held = [pdf[last]]
    if held:
        yield whole()


def _by_shifts(codes: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All near pairs of neighbours in many small runs at once."""
    size = np.diff(edges)
    after = np.repeat(edges[1:], size)
    at = np.flatnonzero(np.repeat(size <= SMALL, size))
    for shift in range(1, SMALL):
        at = at[at + shift < after[at]]
        near = np.bitwise_count(codes[at] ^ codes[at + shift]) <= DISTANCE
        yield at[near], at[near] + shift


def _first_met(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether codes a and b of a variant differ in the bit left out, or meet under their
    segment's first bit, where equal segments meet too."""
    place = key >> 22
    bit = place & 31
    offset = np.array([o for o, _ in SEGMENTS], np.int64)[place >> 5]
    return (bit == 0) | ((a ^ b) >> (offset + bit).astype(np.uint64) & np.uint64(1)).astype(bool)


def _links(by: list[str], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between the fingerprints of each group.  Rows may bring a component, beyond
    which links are looked for."""
    for rows, edges in _runs(batches, by):
        if not len(rows):
            continue
        fp, key = rows["fp"].to_numpy(), rows["key"].to_numpy()
        codes = fp.view(np.uint64)
        component = rows["component"].to_numpy() if "component" in rows else fp
        found = list(_by_shifts(codes, edges))
        for at in np.flatnonzero(np.diff(edges) > SMALL):
            own = slice(edges[at], edges[at + 1])
            found += [(own.start + x, own.start + y) for x, y in spanning_links(codes[own], component[own])]
        a, b = (np.concatenate(v) for v in zip(*found))
        new = _first_met(key[a], codes[a], codes[b])
        yield pd.DataFrame({"a": fp[a[new]], "b": fp[b[new]]})


def _linked_in_groups(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.repartition(*by).sortWithinPartitions(*by).mapInPandas(
        lambda batches: _links(by, batches), "a long, b long").distinct()


def _across_blocks(hot: DataFrame, comps: DataFrame) -> DataFrame:
    """Links that the blocks of hot variants haven't got yet: each two blocks of a
    variant that still holds several components are searched together."""
    rows = hot.join(comps.toDF("fp", "component"), "fp", "left").select(
        "key", "fp", "block", "blocks", F.coalesce("component", "fp").alias("component"))
    several = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    dealt = rows.join(several.select("key"), "key", "left_semi").select(
        "key", "fp", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return _linked_in_groups(
        dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "fp", "component")
        .where("i < j"), ["key", "i", "j"])


def linked_codes(codes: DataFrame) -> DataFrame:
    """Distinct (fp) -> (id, component): the components, by their smallest code, of the
    codes that are within DISTANCE of another."""
    rows = variants(_dealt_out(codes))
    hot = _hot(rows)
    placed = rows.join(hot, "key", "left").select("key", F.coalesce(_block(), F.lit(0)).alias("block"), "fp")
    links = cut(_linked_in_groups(placed, ["key", "block"]), "links")
    if hot.isEmpty():
        return components(links)
    comps = cut(components(links), "components")
    members = rows.join(hot, "key").select("key", "fp", "blocks", _block().alias("block"))
    return components(links.unionByName(_across_blocks(members, comps)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ..) -> (doc_id, fingerprint, component_id), one row per row."""
    rows = cut(fingerprints(docs), "fingerprints")
    codes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")).where("rep is not null"), "codes")

    # Everything between is scratch once the labels are a table.
    with scratch() as made:
        comps = linked_codes(codes.select("fp"))
        labelled = codes.join(comps.withColumnRenamed("id", "fp"), "fp", "left").select(
            "fp", "rep", F.coalesce("component", "fp").alias("component"))
        low = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
        labels = cut(labelled.join(low, "component").select("fp", "component_id"), "labels")
    remove(docs.sparkSession, made[:-1])

    return rows.join(labels, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
