"""Removal of repeated byte strings by a sparse suffix array sorted deep-shallow.

Every LENGTH-byte string that also starts earlier in the corpus (smaller doc_id,
or the same document and an earlier start) is removed, byte by byte.

1. Each window of LENGTH bytes belongs to one *anchor*: its smallest-hashed gram
   of GRAM bytes (leftmost on ties), which depends on the window's bytes only.
   Neighbouring windows share anchors, so a text is a row of *segments*: the
   windows of one anchor, about 37 of them.  Equal windows have equal anchors at
   equal places, whatever stands around them.
2. Segments are shuffled by the hash of their anchor, without their text.  Equal
   ones within a task's batch are merged before the shuffle; of those that are
   equal in full only the first occurrence goes on, the rest is removed.  An
   anchor seen in one form only has no further repeats.
3. Anchors that occur in several forms are suffix-sorted: the text from the
   anchor on, and the text before it backwards, each by multikey quicksort to a
   shallow depth and blind tries below (``suffix_sort``).  Two forms share the
   window that starts j bytes before the anchor if they agree in j bytes
   backwards and LENGTH - j forwards, which the two arrays of common prefixes
   tell for all forms at once.
4. Each document's spans are joined to its text and cut out.

Forms of one anchor are sorted in one task.  An anchor with more than
HOT_FORMS of them is split further: its windows are grouped one by one by their
hash, in a shuffle of their own, with the same result.

Defined results: a null or empty text, or one shorter than LENGTH, loses nothing.
Matches never cross documents.  doc_id is a document's identity: rows that
repeat an id are one place in the corpus, so that equal rows don't remove each
other.  A row with a null id has no place in the order and loses nothing.  Texts
of any length are processed whole.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import alone, by_bytes, cut, mix64, ready
from strata.llm.suffix_sort import deep_shallow

LENGTH = 100
GRAM = 16
GRAMS = LENGTH - GRAM + 1           # in a window
#: Forms of one anchor that one task sorts; more of them are split by window.
HOT_FORMS = 200_000
#: Rows that one round of sorting takes (whole anchors, so it may be more).
ROUND = 50_000

U = np.uint64


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    g = b.astype(U)
    for s in (1, 2, 4):
        g = g[:-s] | (g[s:] << U(8 * s))
    return mix64(mix64(g[:-8]) + g[8:])


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = 1
    while 2 * n <= w:
        v = np.minimum(v[:-n], v[n:])
        n *= 2
    return np.minimum(v[:len(v) - (w - n)], v[w - n:]) if w > n else v


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For all texts together: anchor hash, text number, first window and number
    of windows (starts within the text), anchor's distance from the first window,
    and the bytes' hash of each segment."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = b"".join(texts)
    if sizes.max(initial=0) < LENGTH:
        return tuple(np.empty(0, t) for t in (U, np.int64, np.int64, np.int64, np.int64, U))
    h = gram_hashes(np.frombuffer(flat, np.uint8))
    low = sliding_min((h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U), GRAMS)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - LENGTH + 1, 0))
    counts = np.maximum(sizes - LENGTH + 1, 0)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[owner]
    anchor = (low[at] & U(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    first, n = at[new], np.diff(np.append(new, len(at)))
    anchor, owner = anchor[new], owner[new]
    form = np.fromiter((xxhash.xxh3_64_intdigest(flat[x:y]) for x, y in
                        zip(first.tolist(), (first + n - 1 + LENGTH).tolist())), U, len(first))
    return h[anchor], owner, first - starts[owner], n, anchor - first, form


#: key: anchor hash; form: hash of the segment's bytes, or for a span already
#: known to be a repeat (off = -1) only what deals it out.
SEGMENTS = "key long, form long, doc_id long, place long"


def _pack(first, n, off):
    """First window, number of windows (< 256) and anchor's distance in one long."""
    return first << 16 | n << 8 | off


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    alone()
    for pdf in batches:
        pairs = ((i, t.encode()) for i, t in zip(pdf["doc_id"].tolist(), pdf["text"]) if t)
        for part in by_bytes(pairs, size=lambda p: len(p[1])):
            ids = np.array([i for i, _ in part], np.int64)
            key, owner, first, n, off, form = segments([t for _, t in part])
            doc, place = ids[owner], _pack(first, n, off)
            o = np.lexsort((place, doc, form, key))
            key, form, doc, place = key[o], form[o], doc[o], place[o]
            same = (key[1:] == key[:-1]) & (form[1:] == form[:-1])
            head = np.flatnonzero(np.concatenate([[True], ~same])) if len(key) else np.empty(0, np.int64)
            lead = np.repeat(head, np.diff(np.append(head, len(key))))
            repeat = (doc != doc[lead]) | (place != place[lead])
            is_head = np.zeros(len(key), bool)
            is_head[head] = True
            yield pd.DataFrame({"key": key[is_head].view(np.int64), "form": form[is_head].view(np.int64),
                                "doc_id": doc[is_head], "place": place[is_head]})
            spans = _joined(doc[repeat], place[repeat] >> 16, place[repeat] >> 8 & 255)
            yield pd.DataFrame({"key": mix64(spans[1].astype(U) ^ mix64(spans[0].view(U))).view(np.int64),
                                "form": spans[2], "doc_id": spans[0], "place": ~spans[1]})


def _joined(doc: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows that follow one another in a document, as one run each."""
    if not len(doc):
        return doc, first, n
    o = np.lexsort((first, doc))
    doc, first, n = doc[o], first[o], n[o]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (first[1:] > first[:-1] + n[:-1])]))
    return doc[new], first[new], np.maximum.reduceat(first + n, new) - first[new]


#: key null: a span of n repeated windows from first on; else a form of an anchor.
FORMS = "key long, doc_id long, first long, n long, off long"


def _first_forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (key, form, doc_id, place).  Only the last row and whether its
    key was seen in two forms pass from batch to batch."""
    last = held = None                      # last: (key, form, doc, place) of the current form's first
    several = False
    for pdf in batches:
        known = pdf[pdf["place"] < 0]
        out = [(None, d, ~p, n, -1) for d, p, n in zip(known["doc_id"].tolist(), known["place"].tolist(),
                                                       known["form"].tolist())]
        new = pdf[pdf["place"] >= 0]
        for row in zip(new["key"].tolist(), new["form"].tolist(), new["doc_id"].tolist(), new["place"].tolist()):
            key, form, doc, place = row
            if last is None or key != last[0]:
                last = held = row
                several = False
            elif form != last[1]:
                if not several:
                    out.append(_form(held))
                    several = True
                last = row
                out.append(_form(row))
            elif (doc, place) != last[2:]:
                out.append((None, doc, place >> 16, place >> 8 & 255, -1))
        yield pd.DataFrame(out, columns=["key", "doc_id", "first", "n", "off"]).astype({"key": "Int64"})


def _form(row):
    key, _, doc, place = row
    return key, doc, place >> 16, place >> 8 & 255, place & 255


TEXTS = "key long, doc_id long, first long, off long, piece binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each form, from its document."""
    for batch in batches:
        forms = batch.column("forms")
        counts = np.diff(forms.offsets.to_numpy())
        flat = forms.flatten()
        first, n = (flat.field(c).to_numpy() for c in ("first", "n"))
        owner = np.repeat(np.arange(batch.num_rows), counts)
        texts = batch.column("text").to_pylist()
        pieces, last, raw = [], -1, b""
        for i, a, b in zip(owner.tolist(), first.tolist(), (first + n - 1 + LENGTH).tolist()):
            if i != last:
                last, raw = i, (texts[i] or "").encode()
            pieces.append(raw[a:b])
        yield pa.RecordBatch.from_arrays(
            [flat.field("key"), batch.column("doc_id").take(pa.array(owner)), flat.field("first"),
             flat.field("off"), pa.array(pieces, pa.binary())],
            names=["key", "doc_id", "first", "off", "piece"])


def repeated_windows(key: np.ndarray, rank: np.ndarray, off: np.ndarray, pieces: list[bytes]):
    """(form number, j) of the windows that start j bytes before their anchor and
    are those of a form of smaller rank, too."""
    group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
    n = np.fromiter(map(len, pieces), np.int64, len(pieces)) - LENGTH + 1
    sides = []
    for strings in ([p[o:] for p, o in zip(pieces, off.tolist())],
                    [p[:o][::-1] for p, o in zip(pieces, off.tolist())]):
        sides.append(deep_shallow(strings, group))
    (right, r_lcp), (left, l_lcp) = sides
    by_rank = np.argsort(rank, kind="stable")
    found = []
    for j in range(int(off.max(initial=-1)) + 1):
        mine = by_rank[(off[by_rank] >= j) & (j > off[by_rank] - n[by_rank])]
        r_class, l_class = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
        r_class[right] = np.cumsum(r_lcp < LENGTH - j)
        l_class[left] = np.cumsum(l_lcp < j)
        both = r_class[mine] * (len(key) + 1) + l_class[mine]
        _, at = np.unique(both, return_index=True)
        again = np.ones(len(mine), bool)
        again[at] = False
        found.append(np.stack([mine[again], np.full(int(again.sum()), j)]))
    return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)


SPANS = "doc_id long, first long, n long"


def _spans_of(pdf: pd.DataFrame) -> pd.DataFrame:
    key, doc = pdf["key"].to_numpy(), pdf["doc_id"].to_numpy()
    first, off = pdf["first"].to_numpy(), pdf["off"].to_numpy()
    rank = np.empty(len(key), np.int64)
    rank[np.lexsort((first + off, doc))] = np.arange(len(key))
    who, j = repeated_windows(key, rank, off, pdf["piece"].tolist())
    start = first[who] + off[who] - j
    return pd.DataFrame(dict(zip(("doc_id", "first", "n"),
                                 _joined(doc[who], start, np.ones(len(who), np.int64)))))


def _sort_forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by key: whole anchors, about ROUND rows at a time."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        held.append(pdf)
        if sum(map(len, held)) < ROUND:
            continue
        rows = pd.concat(held, ignore_index=True)
        last = rows["key"] == rows["key"].iloc[-1]
        held = [rows[last]]
        if not last.all():
            yield _spans_of(rows[~last].reset_index(drop=True))
    if held:
        yield _spans_of(pd.concat(held, ignore_index=True))


def _hot_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for part in by_bytes(zip(pdf["doc_id"], pdf["first"], pdf["piece"]), size=lambda p: 8 * len(p[2])):
            rows = [(*np.frombuffer(xxhash.xxh3_128_digest(p[i:i + LENGTH]), np.int64), d, f + i)
                    for d, f, p in part for i in range(len(p) - LENGTH + 1)]
            yield pd.DataFrame(rows, columns=["hi", "lo", "doc_id", "first"])


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, first, n): n windows of LENGTH bytes from byte
    ``first`` on that start earlier in the corpus, too."""
    ready(docs.sparkSession)
    known = docs.select("doc_id", "text").where("doc_id is not null")
    rows = (known.mapInPandas(_segments, SEGMENTS).repartition("key")
            .sortWithinPartitions("key", "form", "doc_id", "place")
            .mapInPandas(_first_forms, FORMS))
    rows = cut(rows, "repeats")
    spans = rows.where("key is null").select("doc_id", "first", "n")
    forms = rows.where("key is not null")

    per_doc = forms.groupBy("doc_id").agg(F.collect_list(F.struct("key", "first", "n", "off")).alias("forms"))
    texts = known.join(per_doc, "doc_id").mapInArrow(_pieces, TEXTS)
    hot = cut(forms.groupBy("key").agg(F.count(F.lit(1)).alias("forms")).where(F.col("forms") > HOT_FORMS), "hot")
    some = not hot.isEmpty()
    if some:
        texts = cut(texts, "forms")
    cool = texts.join(hot, "key", "left_anti") if some else texts
    out = spans.unionByName(
        cool.repartition("key").sortWithinPartitions("key").mapInPandas(_sort_forms, SPANS))
    if some:
        windows = texts.join(hot, "key", "left_semi").mapInPandas(
            _hot_windows, "hi long, lo long, doc_id long, first long")
        earliest = windows.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "first")).alias("e"))
        out = out.unionByName(
            windows.join(earliest, ["hi", "lo"])
            .where((F.col("doc_id") != F.col("e.doc_id")) | (F.col("first") != F.col("e.first")))
            .select("doc_id", "first", F.lit(1).cast("long").alias("n")))
    return out


def cover(first: np.ndarray, n: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal byte runs that spans of windows cover."""
    out: list[list[int]] = []
    o = np.argsort(first, kind="stable")
    for a, b in zip(first[o].tolist(), (first + n - 1 + LENGTH)[o].tolist()):
        a, b = min(a, size), min(b, size)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        elif b > a:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with a last column of the spans of its document."""
    name = "spans"
    while name in docs.columns:
        name += "_"
    per_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("first", "n")).alias(name))
    return docs.join(per_doc, "doc_id", "left").select(*[docs[c] for c in docs.columns], name)


def _kept(batch: pa.RecordBatch):
    """Each row's bytes, runs removed, and bytes kept."""
    spans = batch.column(batch.num_columns - 1)
    flat = spans.flatten()
    first, n = (flat.field(c).to_numpy() for c in ("first", "n"))
    ends = np.cumsum(np.diff(spans.offsets.to_numpy()) * spans.is_valid().to_numpy(zero_copy_only=False))
    at = 0
    for text, end in zip(batch.column("text").to_pylist(), ends.tolist()):
        raw = (text or "").encode()
        runs = cover(first[at:end], n[at:end], len(raw))
        at = end
        parts, x = [], 0
        for a, b in runs:
            parts.append(raw[x:a])
            x = b
        yield raw, runs, b"".join([*parts, raw[x:]])


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
                for raw, runs, kept in _kept(batch)]
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(),) * 3 + (pa.string(),))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: bytes, bytes and runs removed, digest of the rest."""
    docs = docs.select("doc_id", "text")
    return _with_spans(docs, repeats(docs)).mapInArrow(_report, REPORT)


def _texts(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        cleaned = [kept.decode("utf-8", "ignore") if valid else None
                   for (_, _, kept), valid in zip(_kept(batch), text.is_valid().to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cleaned, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``; every row and column
    stays.  A character of which bytes were removed goes as a whole."""
    return _with_spans(docs, repeats(docs)).mapInArrow(partial(_texts, docs.columns), docs.schema)
