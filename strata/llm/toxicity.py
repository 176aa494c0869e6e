"""Toxic words in texts by a subsequence string-kernel support vector machine.

Kernel: two words are alike by the three-letter subsequences they share, each
occurrence weighted by DECAY to the length it spans (at most SPAN characters), so
that gaps and inserted characters cost little; normalised to 1 for equal words.
Words are what white space parts, without the marks in them; a run of single
characters counts as one word ("s t u p i d").

Nystroem: a word's features are its kernel values with LANDMARKS words, whitened
by the landmarks' own kernel matrix.  A linear support vector machine on them is a
weighted sum of kernel values, which is a weighted sum over the word's
subsequences: one table lookup for each.

Training: labels are those of whole texts, cut into sentences.  Every word of a
clean text is clean; in a toxic text the words with the strongest signs are the
witnesses (found first by how often words occur in toxic and in clean texts, then by
the machine itself).  Clean words that the machine takes for toxic join its training in
each round.  A text's margin is the largest of its words'; a logistic curve fitted on
training texts turns it into a score.  Insults are words, however stretched, gapped or
spaced out: one that is only offensive as several words together is not seen.

Fitting uses at most TRAIN_ROWS texts of each label on the driver; of a text longer than
TRAIN_CHARS characters a piece of that size is taken where a label has too few others.
Scoring reads every text whole in one pass without a shuffle; unbroken runs longer than
RUN characters are scored in overlapping windows.

Defined results: a null or empty text, or one without a word, has the lowest score
there is.  Without training texts of both labels every score is 0.  Rows repeat as
they come; ids may be null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bucket_of, labelled_pieces, ready, remembers

DECAY, SPAN = 0.6, 7
ALPHABET = 64
LANDMARKS = 192
TRAIN_ROWS, TRAIN_CHARS = 3000, 10_000
ROUNDS = 3
#: A word so many times commoner in toxic texts, and so often there, is no clean one.
SURE_SIGN, SURE_TEXTS = 20.0, 10
CACHE_WORDS = 200_000
RUN = 48                    # characters of a window of a long run, half of it shared
LOWEST = -4.0               # margin of a text without words

SPACED = re.compile(r"(?<!\S)\S(?:[^\S\n]\S(?!\S))+")
SPACES, MARKS = re.compile(r"\s"), re.compile(r"[^\w\s]|_")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")

#: Distances of the second and third character, and the weight of what they span.
GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def words_of(sentence: str) -> list[str]:
    """Its words; of one longer than RUN characters, overlapping windows of that size, so
    that an insult inside a long run is not thinned out, and memory stays bounded."""
    joined = SPACED.sub(lambda m: SPACES.sub("", m[0]), sentence.lower())
    words = MARKS.sub("", joined).split()
    if max(map(len, words), default=0) <= RUN:
        return words
    return [w[i:i + RUN] for w in words for i in range(0, max(1, len(w) - RUN // 2), RUN // 2)]


def _codes(words: list[str]) -> np.ndarray:
    """Characters as numbers below ALPHABET (a-z each their own, others by hash),
    0 past a word's end."""
    width = max(SPAN, max(map(len, words)))
    # Four bytes a character, the rest of the row zero.
    wide = np.frombuffer("".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le"), np.uint32)
    c = wide.reshape(len(words), width)
    letter = (c >= 97) & (c <= 122)
    other = 27 + (c * np.uint32(2654435761) >> np.uint32(16)) % (ALPHABET - 27)
    return np.where(c == 0, 0, np.where(letter, c - 96, other)).astype(np.int64)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (0: none) and weights of each word's subsequences of three."""
    c = _codes(words)
    keys, weights = [], []
    for a, b in GAPS:
        x, y, z = c[:, :-b], c[:, a:c.shape[1] - b + a], c[:, b:]
        keys.append(np.where(z > 0, (x * ALPHABET + y) * ALPHABET + z, 0))
        weights.append(np.full(keys[-1].shape, DECAY ** (b + 1)))
    return np.concatenate(keys, axis=1), np.concatenate(weights, axis=1)


def norms(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square root of each word's kernel with itself."""
    o = np.argsort(keys, axis=1, kind="stable")
    k, w = np.take_along_axis(keys, o, 1), np.take_along_axis(weights, o, 1)
    w = np.where(k > 0, w, 0.0)
    total = np.cumsum(w, axis=1)
    last = np.concatenate([k[:, 1:] != k[:, :-1], np.ones((len(k), 1), bool)], axis=1)
    ends = np.where(last, total, 0.0)
    before = np.maximum.accumulate(np.concatenate([np.zeros((len(k), 1)), ends[:, :-1]], axis=1), axis=1)
    own = np.where(last, total - before, 0.0)
    return np.sqrt((own**2).sum(axis=1))


def _blocks(words: list[str], size: int = 2048):
    """Words of about the same length together, with their numbers."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        room = max(1, size * 16 // max(16, len(words[order[min(at + size, len(order)) - 1]])))
        part = order[at:at + min(size, room)]
        yield part, [words[i] for i in part]
        at += len(part)


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of words (rows) with landmarks."""
    lk, lw = subsequences(landmarks)
    used = np.unique(lk[lk > 0])
    table = np.zeros((len(used) + 1, len(landmarks)))
    row = np.where(lk > 0, np.searchsorted(used, lk), len(used))
    np.add.at(table, (row, np.arange(len(landmarks))[:, None]), lw)
    table[-1] = 0
    table /= np.maximum(norms(lk, lw), 1e-12)
    place = np.full(ALPHABET**3, len(used))
    place[used] = np.arange(len(used))
    out = np.empty((len(words), len(landmarks)))
    for part, own in _blocks(words, 512):
        k, w = subsequences(own)
        n = np.maximum(norms(k, w), 1e-12)
        out[part] = np.einsum("ij,ijl->il", w, table[place[k]]) / n[:, None]
    return out


@dataclass
class Machine:
    table: np.ndarray       # weight of each subsequence
    bias: float
    slope: float
    offset: float
    key: int = 0

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        for part, own in _blocks(words):
            k, w = subsequences(own)
            n = np.maximum(norms(k, w), 1e-12)
            out[part] = (w * self.table[k]).sum(axis=1) / n + self.bias
        return out

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def _table(landmarks: list[str], alpha: np.ndarray) -> np.ndarray:
    k, w = subsequences(landmarks)
    w = w * (alpha / np.maximum(norms(k, w), 1e-12))[:, None]
    table = np.zeros(ALPHABET**3)
    np.add.at(table, k, w)
    table[0] = 0
    return table


def hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 300) -> tuple[np.ndarray, float]:
    """A linear machine by gradient steps on the squared hinge loss."""
    w, b = np.zeros(x.shape[1]), 0.0
    lead_w, lead_b = w, b
    with_bias = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    rate = 1 / (2 * np.linalg.eigvalsh(with_bias.T @ (cost[:, None] * with_bias))[-1] + 1e-4)
    for t in range(steps):
        gap = np.maximum(0, 1 - y * (x @ lead_w + lead_b))
        g = -2 * cost * y * gap
        new_w, new_b = lead_w - rate * (x.T @ g + 1e-4 * lead_w), lead_b - rate * g.sum()
        pull = t / (t + 3)
        lead_w, lead_b = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    return w, b


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a small penalty."""
    p, q = 1.0, 0.0
    for _ in range(50):
        s = 1 / (1 + np.exp(-np.clip(p * x + q, -30, 30)))
        r = s * (1 - s) + 1e-9
        g = np.array([((s - y) * x).sum() + 0.05 * p, (s - y).sum()])
        h = np.array([[(r * x * x).sum() + 0.05, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        p, q = p - np.clip(step[0], -2, 2), q - np.clip(step[1], -2, 2)
    return float(p), float(q)


def fit(texts: list[tuple[str, int]]) -> Machine | None:
    """A machine from (text, 0 or 1) pairs."""
    texts = sorted(texts)
    if len({y for _, y in texts}) < 2:
        return None
    rng = np.random.default_rng(11)
    cut = [([words_of(s) for s in SENTENCE.split(t)], y) for t, y in texts]
    # A word counts once after each different word, so that copies of a text, and
    # near copies, don't make all of its words look common.
    pairs: list[set] = [set(), set()]
    for sentences, y in cut:
        for ws in sentences:
            pairs[y].update(zip(["", *ws], ws))
    seen = [Counter(w for _, w in p) for p in pairs]
    n_clean, n_toxic = (sum(y == k for _, y in cut) for k in (0, 1))
    signs = {w: (n / n_toxic) / (seen[0][w] / n_clean + 0.5 / n_clean) for w, n in seen[1].items()}
    # Labels are not perfect: a word much commoner in toxic texts may occur in a clean one.
    sure = {w for w, r in signs.items() if r >= SURE_SIGN and seen[1][w] >= SURE_TEXTS}
    clean = sorted(seen[0].keys() - sure)
    toxic_texts = [s for s, y in cut if y == 1 and any(s)]
    rate = lambda ws: np.array([signs[w] for w in ws])

    model, hard = None, []
    for _ in range(ROUNDS):
        pool = sorted({w for s in toxic_texts for ws in s for w in ws}.difference(clean))
        strength = dict(zip(pool, rate(pool) if model is None else model.margins(pool) + 1e-3 * np.log(rate(pool))))
        witness = Counter()
        for sentences in toxic_texts:
            own = {w for ws in sentences for w in ws}
            best = max(((strength.get(w, -9.0), w) for w in own), default=(-9.0, ""))
            found = own & sure
            if not found and best[0] > (1.0 if model is None else 0.0):
                found = {best[1]}
            witness.update(found)
        if model is None:
            witness = Counter({w: n for w, n in witness.items() if seen[1][w] > 1}) or witness
        if not witness:
            return model
        plus = [w for w, _ in witness.most_common(3000)]
        minus = [clean[i] for i in rng.permutation(len(clean))[:4000]] + hard
        often = [w for w, _ in seen[0].most_common(2000)]
        half = LANDMARKS // 2
        landmarks = list(dict.fromkeys([*plus[:half], *hard[-half // 2:], *often[:half // 4], *minus[:half]]))[:LANDMARKS]
        own = kernel(landmarks, landmarks)
        value, vector = np.linalg.eigh(own)
        good = value > 1e-6 * value.max()
        whiten = vector[:, good] / np.sqrt(value[good])
        minus = list(dict.fromkeys(minus + often))
        x = kernel(plus + minus, landmarks) @ whiten
        y = np.repeat([1.0, -1.0], [len(plus), len(minus)])
        cost = np.concatenate([np.full(len(plus), 1 / len(plus)), np.full(len(minus), 1 / len(minus))])
        w, b = hinge(x, y, cost)
        model = Machine(_table(landmarks, whiten @ w), b, 1.0, 0.0)
        margin = model.margins(clean)
        worst = np.argsort(-margin, kind="stable")[:1500]
        hard = list(dict.fromkeys(hard + [clean[i] for i in worst if margin[i] > -0.7]))
    best = np.array([max([float(m) for m in [LOWEST]] + model.margins(ws).tolist()) if ws else LOWEST
                     for ws in ([w for s in sentences for w in s] for sentences, _ in cut)])
    model.slope, model.offset = logistic(best, np.array([y for _, y in cut], float))
    model.key = zlib.crc32(model.table.tobytes())
    return model


_memory: dict = {"key": None, "words": {}}
remembers("toxicity", lambda: _memory.update(key=None, words={}))


def text_margins(model: Machine, texts: list[str | None]) -> np.ndarray:
    """The largest margin over each text's words."""
    if _memory["key"] != model.key or len(_memory["words"]) > CACHE_WORDS:
        _memory.update(key=model.key, words={})
    known = _memory["words"]
    lists = [words_of(t) if t else [] for t in texts]
    new = list({w for ws in lists for w in ws if w not in known})
    known.update(zip(new, model.margins(new).tolist()) if new else ())
    return np.array([max(map(known.__getitem__, ws), default=LOWEST) for ws in lists])


def _score(model: Machine | None, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 1000):
            part = pdf.iloc[at:at + 1000]
            score = np.zeros(len(part)) if model is None else model.score(text_margins(model, part["text"].tolist()))
            yield pd.DataFrame({"doc_id": part["doc_id"].array, "score": score})


def train(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """A machine from (doc_id, text) and (doc_id, label); see the module's text for the sample."""
    return fit(labelled_pieces(docs, labels.where("label in (0, 1)"), 2 * TRAIN_ROWS, 0, TRAIN_CHARS))


def score(docs: DataFrame, model: Machine | None) -> DataFrame:
    """(doc_id, text) -> (doc_id, score)."""
    ready(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(partial(_score, model), "doc_id long, score double")


def held_out(column: str = "doc_id"):
    return F.coalesce(bucket_of(column, 5) == 0, F.lit(False))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.where(~held_out()).select("doc_id", F.col("toxic").alias("label"))
    model = train(docs.select("doc_id", "text"), known)
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
