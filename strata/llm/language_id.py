"""Language of texts, word by word, by a linear-chain conditional random field.

A text is a chain of words (runs of letters), each with one language as its
label.  A word's score for a label sums weights of hashed features: affixes of one
to four letters, letter n-grams, and whether a lexicon lists it; neighbouring
labels score learned transitions.  Forward-backward gives each word's label
probabilities over the whole chain, so that a passage in another language shows as
one; the text's language is the one with most probability, averaged over words.

The field is fitted on the driver by stochastic gradients of the log-likelihood
(expected less observed features, by the same forward-backward) on a sample of about
TRAIN_ROWS labelled texts, alike for all labels and LEAST_ROWS of each at least; of a
text longer than TRAIN_CHARS characters a piece of that size is taken where a label has
too few others.  Chains are pieces of texts of several languages put together, so that
the transitions see switches.  Labelling itself reads every text whole, in one pass
without a shuffle; a text of any length is one chain.

Defined results: a text that is null or has no letter is ``und`` with score 0.
Without any labelled text to learn from, all are, and a filter by language
(``accepted``) raises ``ValueError`` instead of dropping every row.  Ties go to the
first language by name.  Rows repeat as they come; ids may be null; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import alone, bucket_of, labelled_pieces, ready, remembers

TRAIN_ROWS = 2000
LEAST_ROWS = 100            # of each label, however many there are
TRAIN_CHARS = 10_000
EPOCHS = 3
CHAIN = 200                 # words of a training chain
BUCKETS = 1 << 16
LEXICON = 20_000
UNKNOWN = "und"
#: Words whose label scores a worker remembers, and words labelled at once.
CACHE_WORDS, ROUND_WORDS = 150_000, 200_000
#: Feature names whose buckets it remembers.
CACHE_NAMES = 300_000

WORD = re.compile(r"[^\W\d_]+")


#: Buckets of feature names seen by this process.
_buckets: dict[str, int] = {}


def _bucket(name: str) -> int:
    if len(_buckets) >= CACHE_NAMES:
        _buckets.clear()
    found = _buckets[name] = zlib.crc32(name.encode()) % BUCKETS
    return found


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    n = len(word)
    edged = f"<{word}>"
    names = ["p" + word[:k] for k in range(1, min(4, n) + 1)]
    names += ["s" + word[-k:] for k in range(1, min(4, n) + 1)]
    names += map("".join, zip(edged, edged[1:]))
    names += map("".join, zip(edged, edged[1:], edged[2:]))
    if word in lexicon:
        names.append(f"x{lexicon[word]}")
    found = list(map(_buckets.get, names))
    return found if None not in found else [_bucket(x) if f is None else f for x, f in zip(names, found)]


def packed(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of chains of non-increasing ``lengths`` when laid out step by step:
    chains alive at each step, where each step starts, and each word's place in
    chain order."""
    steps = int(lengths[0])
    alive = np.searchsorted(-lengths, -np.arange(steps), side="left")
    starts = np.concatenate([[0], np.cumsum(alive)])
    chain = np.repeat(np.arange(len(lengths)), lengths)
    step = np.arange(len(chain)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return alive, starts, starts[step] + chain


def forward_backward(emit: np.ndarray, move: np.ndarray, start: np.ndarray, lengths: np.ndarray,
                     pairs: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities of each word of the chains (chain order).  ``emit``,
    ``move`` and ``start`` are exponentials of scores; if given, ``pairs`` gets the
    expected number of transitions added."""
    alive, starts, place = packed(lengths)
    e = np.empty_like(emit)
    e[place] = emit
    a = np.empty_like(e)
    for t, n in enumerate(alive):
        x = a[starts[t - 1]:starts[t - 1] + n] @ move if t else np.broadcast_to(start, (n, len(start)))
        x = x * e[starts[t]:starts[t] + n]
        a[starts[t]:starts[t] + n] = x / x.sum(axis=1, keepdims=True)
    b = np.ones((len(lengths), e.shape[1]))
    out = np.empty_like(a)
    for t in range(len(alive) - 1, -1, -1):
        n, at = alive[t], slice(starts[t], starts[t] + alive[t])
        x = a[at] * b[:n]
        out[at] = x / x.sum(axis=1, keepdims=True)
        back = e[at] * b[:n]
        if pairs is not None and t:
            before = a[starts[t - 1]:starts[t - 1] + n]
            z = (before @ move * back).sum(axis=1, keepdims=True)
            pairs += move * (before.T @ (back / z))
        back = back @ move.T
        b[:n] = back / back.sum(axis=1, keepdims=True)
    return out[place]


@dataclass
class Field:
    labels: list[str]
    weights: np.ndarray
    move: np.ndarray
    start: np.ndarray
    lexicon: dict[str, int]
    key: int = 0

    def emissions(self, words: list[str]) -> np.ndarray:
        listed = [features(w, self.lexicon) for w in words]
        starts = np.cumsum([0, *map(len, listed[:-1])])
        s = np.add.reduceat(self.weights[np.fromiter(itertools.chain.from_iterable(listed), np.int64)], starts, axis=0)
        return np.exp(s - s.max(axis=1, keepdims=True))


def fit(texts: list[tuple[str, str]]) -> Field | None:
    """A field from (text, label) pairs."""
    labels = sorted({label for _, label in texts})
    if not labels:
        return None
    index = {x: i for i, x in enumerate(labels)}
    rng = np.random.default_rng(7)
    # Texts become word numbers at once: a word is one string however often it occurs.
    vocabulary: dict[str, int] = {}
    docs = [(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in WORD.findall(t.lower())], np.int32), index[y])
            for t, y in sorted(texts)]
    docs = [d for d in docs if len(d[0])]
    words = list(vocabulary)
    counts = np.zeros((len(words), len(labels)), np.int32)
    for ws, y in docs:
        counts[np.unique(ws), y] += 1
    total = counts.sum(axis=1)
    often = sorted(range(len(words)), key=lambda i: (total[i], words[i]), reverse=True)[:LEXICON]
    lexicon = {words[i]: int(counts[i].argmax()) for i in often if total[i] > 2 and counts[i].max() >= 0.9 * total[i]}

    # Chains: every third of the pieces is cut in two and dealt out, so chains switch.
    pieces = [(ws[i:i + CHAIN], y) for ws, y in docs for i in range(0, len(ws), CHAIN)]
    halves = [(part, y) for k, (ws, y) in enumerate(pieces) if k % 3 == 0
              for part in (ws[:len(ws) // 2], ws[len(ws) // 2:]) if len(part)]
    order = rng.permutation(len(halves))
    chains = [[p] for k, p in enumerate(pieces) if k % 3]
    chains += [[halves[i] for i in order[k:k + 3]] for k in range(0, len(order), 3)]

    flat, sizes = array("I"), np.empty(len(words), np.int64)
    for i, w in enumerate(words):
        own = features(w, lexicon)
        sizes[i] = len(own)
        flat.extend(own)
    _buckets.clear()
    flat = np.frombuffer(flat, np.uint32)
    ends = np.cumsum(sizes)
    k = len(labels)
    model = Field(labels, np.zeros((BUCKETS, k)), np.eye(k), np.zeros(k), lexicon)
    grads = [np.full_like(x, 1e-6) for x in (model.weights, model.move, model.start)]
    for _ in range(EPOCHS):
        deal = rng.permutation(len(chains))
        for part in np.array_split(deal, max(1, len(chains) // 256)):
            own = sorted((chains[i] for i in part), key=lambda c: -sum(len(ws) for ws, _ in c))
            lengths = np.array([sum(len(ws) for ws, _ in c) for c in own])
            ids = np.concatenate([ws for c in own for ws, _ in c])
            truth = np.repeat([y for c in own for _, y in c], [len(ws) for c in own for ws, _ in c])
            used, local = np.unique(ids, return_inverse=True)
            n = sizes[used]
            at = np.repeat(ends[used] - n, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            rows = np.cumsum(n) - n
            score = np.add.reduceat(model.weights[flat[at]], rows, axis=0)
            expected = np.zeros((k, k))
            emit = np.exp(score - score.max(axis=1, keepdims=True))[local]
            p = forward_backward(emit, np.exp(model.move), np.exp(model.start), lengths, expected)
            gap = p
            gap[np.arange(len(truth)), truth] -= 1
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, local, gap)
            g_weights = np.zeros_like(model.weights)
            np.add.at(g_weights, flat[at], np.repeat(by_word, n, axis=0))
            firsts = np.cumsum(lengths) - lengths
            inner = np.ones(len(truth), bool)
            inner[firsts] = False
            seen = np.zeros((k, k))
            np.add.at(seen, (truth[np.flatnonzero(inner) - 1], truth[inner]), 1)
            for x, g, total in ((model.weights, g_weights, grads[0]), (model.move, expected - seen, grads[1]),
                                (model.start, gap[firsts].sum(axis=0), grads[2])):
                total += g * g
                x -= 0.2 * g / np.sqrt(total)
    model.weights = model.weights.astype(np.float32)
    model.key = zlib.crc32(model.weights.tobytes())
    return model


#: Remembered label scores of one worker process, for one field at a time.
_memory: dict = {"key": None, "words": {}, "rows": None}


def _forget() -> None:
    _buckets.clear()
    _memory.update(key=None, words={}, rows=None)


remembers("language_id", _forget)


def _scores(model: Field, words: list[str]) -> np.ndarray:
    m = _memory
    if m["key"] != model.key or len(m["words"]) > CACHE_WORDS:
        m.update(key=model.key, words={}, rows=np.empty((0, len(model.labels))))
    known = m["words"]
    ids = list(map(known.get, words))
    if None in ids:
        new = list(dict.fromkeys(w for w, i in zip(words, ids) if i is None))
        at = len(known)
        known.update(zip(new, range(at, at + len(new))))
        if len(known) > len(m["rows"]):
            more = np.empty((max(len(known), 2 * len(m["rows"])), len(model.labels)))
            more[:at] = m["rows"][:at]
            m["rows"] = more
        m["rows"][at:len(known)] = model.emissions(new)
        ids = list(map(known.__getitem__, words))
    return m["rows"][np.array(ids, np.int64)]


def label_chains(model: Field, chains: list[list[str]]) -> list[np.ndarray]:
    """Each chain's label probabilities, word by word."""
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    out: list = [None] * len(chains)
    at = 0
    while at < len(order) and chains[order[at]]:
        part, total = [], 0
        while at < len(order) and chains[order[at]] and (not part or total + len(chains[order[at]]) <= ROUND_WORDS):
            part.append(order[at])
            total += len(chains[order[at]])
            at += 1
        lengths = np.array([len(chains[i]) for i in part])
        emit = _scores(model, [w for i in part for w in chains[i]])
        p = forward_backward(emit, np.exp(model.move), np.exp(model.start), lengths)
        for i, x in zip(part, np.split(p, np.cumsum(lengths)[:-1])):
            out[i] = x
    return out


def judge(model: Field | None, texts: list[str | None]) -> list[tuple[str, float, list[float] | None]]:
    """Language, score and shares of all languages of each text."""
    told: list = [(UNKNOWN, 0.0, None)] * len(texts)
    if model is not None:
        chains = [WORD.findall(t.lower()) if t else [] for t in texts]
        for i, p in enumerate(label_chains(model, chains)):
            if p is not None:
                mean = p.mean(axis=0)
                told[i] = model.labels[int(mean.argmax())], min(1.0, float(mean.max())), mean.tolist()
    return told


def _label(model: Field | None, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    alone("language_id")
    for pdf in batches:
        for at in range(0, len(pdf), 2000):
            part = pdf.iloc[at:at + 2000]
            told = judge(model, part["text"].tolist())
            yield pd.DataFrame({"doc_id": part["doc_id"].array, "lang_pred": [x[0] for x in told],
                                "score": [x[1] for x in told], "shares": [x[2] for x in told]})


def train(labelled: DataFrame) -> Field | None:
    """A field from (doc_id, text, lang) rows; see the module's text for the sample."""
    usable = labelled.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").alias("label"))
    return fit(labelled_pieces(usable, usable.select("doc_id", "label"), TRAIN_ROWS, LEAST_ROWS, TRAIN_CHARS))


def identify(docs: DataFrame, model: Field | None) -> DataFrame:
    """(doc_id, text) -> (doc_id, lang_pred, score, shares of all languages by name)."""
    ready(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(
        partial(_label, model), "doc_id long, lang_pred string, score double, shares array<double>")


def _accept(model: Field, least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    alone("language_id")
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            yield part.filter(pa.array([lang != UNKNOWN and score >= least
                                        for lang, score, _ in judge(model, part.column("text").to_pylist())]))


def accepted(docs: DataFrame, model: Field | None, least: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known with a
    score of at least ``least``."""
    ready(docs.sparkSession)
    if model is None:
        if docs.isEmpty():
            return docs
        raise ValueError("no labelled text to learn languages from: every row would be dropped")
    return docs.mapInArrow(partial(_accept, model, least), docs.schema)


def held_out(column: str = "doc_id"):
    return F.coalesce(bucket_of(column, 4) == 2, F.lit(False))


def predictions(docs: DataFrame) -> DataFrame:
    """Learn from the documents that aren't held out, label all."""
    model = train(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
