"""Text quality from preferences: a Bradley-Terry model over text features.

A good text is preferred to a poor one.  The model gives each text a score w.x of
its features x such that P(a preferred to b) = 1 / (1 + exp(-(w.x_a - w.x_b))); w is
learned by Newton steps on the logistic loss of the feature differences.  The threshold
is a quantile of the training texts' scores: the share of poor texts among them.  Scores
are reported on the logistic scale with that quantile at CUTOFF.

Features are of the whole text: lengths, shares of letters, capitals, digits,
symbols and marks, of distinct and repeated words, lines and neighbours.

``train`` learns from every labelled text, and from every pair of a good and a poor one:
a step needs, for each text, only sums over the scores of the other kind, which are shared
out over points BIN apart.  Counts and feature sums by point, and one small matrix a task, reach the
driver.  The threshold is the exact quantile of all training scores.  (``fit``
learns from rows at hand and PAIRS drawn pairs.)  Features are worked out once, and
stored; learning and scoring read those.

Defined results: a null text is an empty one; an empty text, or one without a word,
has the features of none (all zero) and a score like any other.  Without training
texts of both labels every score is 0.  Rows repeat as they come; ids may be null;
an empty table gives no rows; long texts are processed whole; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bucket_of, cut, ready, remove, scratch

PAIRS = 40_000
CUTOFF = 0.3
PENALTY = 1e-3
#: Distance of the points that scores are shared out over, up to FAR on either side of zero.
BIN = 1 / 16
FAR = 32
STEPS = 25
#: Bins into which a quantile's range is cut at a time.
CUTS = 1024

FEATURES = ("log_chars", "log_words", "word_length", "lower", "upper", "digits", "spaces", "sentence_marks",
            "symbols", "words_with_symbols", "words_of_symbols", "all_capitals", "distinct_words", "commonest_word",
            "same_neighbours", "distinct_pairs", "distinct_lines", "line_length", "sentences", "longest_word")

_LOWER = re.compile(r"[a-zà-öø-ÿ]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SYMBOL = re.compile(r"[^\w\s.,;:'’()\-]")
_MARK = re.compile(r"[.,;:]")
_SENTENCE = re.compile(r"[.!?](?:\s|$)")
#: Characters that words only hold if something is wrong with them.
_ODD = re.compile(r"\S*[^\w\s.,;:'’()\-]\S*")
_BARE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")
_CAPITALS = re.compile(r"(?<!\S)\W*[A-ZÀ-ÖØ-Þ]{2,}\W*(?!\S)")


def _count(pattern: re.Pattern, text: str) -> int:
    return len(pattern.findall(text))


def features(text: str | None) -> list[float]:
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n, w = len(text), len(words)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(n), np.log1p(w), (n - w + 1) / w,
        _count(_LOWER, text) / n, _count(_UPPER, text) / n, sum(map(text.count, "0123456789")) / n,
        (text.count(" ") + text.count("\n")) / n, _count(_MARK, text) / w, _count(_SYMBOL, text) / n,
        _count(_ODD, text) / w, _count(_BARE, text) / w, _count(_CAPITALS, text) / w,
        len(counts) / w, max(counts.values()) / w,
        sum(a == b for a, b in zip(words, words[1:])) / w,
        len(set(zip(words, words[1:]))) / w, len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        _count(_SENTENCE, text) / w, np.log1p(max(map(len, counts))),
    ]


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.strength(x) - self.threshold + np.log(CUTOFF / (1 - CUTOFF))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, label: np.ndarray) -> Ranking | None:
    """A ranking from features and labels (1 preferred to 0)."""
    good, poor = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(poor):
        return None
    rng = np.random.default_rng(5)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    d = z[rng.choice(good, PAIRS)] - z[rng.choice(poor, PAIRS)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (p - 1) / PAIRS + PENALTY * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / PAIRS + PENALTY * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    model = Ranking(mean, scale, w, 0.0)
    s = model.strength(x)
    # The quantile lies between two training scores; half way is farthest from both.
    model.threshold = float(np.quantile(s, len(poor) / len(x), method="midpoint"))
    return model


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"].array,
                            "x": [None if t is None else features(t) for t in pdf["text"]]})


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, x), stored; a null text has no x."""
    ready(docs.sparkSession)
    return cut(docs.select("doc_id", "text").mapInPandas(_features, "doc_id long, x array<double>"), "quality-features")


def _strength(mean, scale, weights):
    """``Ranking.strength`` of the column x."""
    parts = [F.least(F.greatest((F.coalesce(F.col("x")[i], F.lit(0.0)) - F.lit(float(m))) / F.lit(float(c)),
                                F.lit(-8.0)), F.lit(8.0)) * F.lit(float(w))
             for i, (m, c, w) in enumerate(zip(mean, scale, weights))]
    return reduce(lambda a, b: a + b, parts)


def _placed(model: Ranking, pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Standardised features, the bins below the scores, and how far on the way to the next."""
    x = np.array(pdf["x"].tolist()).reshape(len(pdf), len(model.mean))
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    at = (np.clip(z @ model.weights, -FAR, FAR) + FAR) / BIN
    low = np.minimum(at.astype(int), 2 * int(FAR / BIN) - 1)
    return z, low, at - low


def _binned(model: Ranking, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's counts and sums of standardised features by label and bin of the score; each
    text is shared between the two bins that its score lies between."""
    bins, n = 2 * int(FAR / BIN) + 1, len(model.mean)
    count, total = np.zeros((2, bins)), np.zeros((2, bins, n))
    for pdf in batches:
        z, low, way = _placed(model, pdf)
        label = pdf["label"].to_numpy()
        for at, share in ((low, 1 - way), (low + 1, way)):
            np.add.at(count, (label, at), share)
            np.add.at(total, (label, at), z * share[:, None])
    label, at = np.nonzero(count)
    yield pd.DataFrame({"label": label, "bin": at, "n": count[label, at], "z": list(total[label, at])})


def _curvature(model: Ranking, weight: np.ndarray, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's sum of z z' weighted by label and bin."""
    n = len(model.mean)
    total = np.zeros((n, n))
    for pdf in batches:
        z, low, way = _placed(model, pdf)
        label = pdf["label"].to_numpy()
        total += (z * (weight[label, low] * (1 - way) + weight[label, low + 1] * way)[:, None]).T @ z
    yield pd.DataFrame({"z": [total.ravel()]})


def _step(rows: DataFrame, model: Ranking) -> np.ndarray:
    """The Newton step of the loss over all pairs of a good and a poor text."""
    edge, n = int(FAR / BIN), len(model.mean)
    count, total = np.zeros((2, 2 * edge + 1)), np.zeros((2, 2 * edge + 1, n))
    of_task = rows.mapInPandas(partial(_binned, model), "label int, bin int, n double, z array<double>")
    for r in of_task.groupBy("label", "bin").agg(
            F.sum("n"), *[F.sum(F.col("z")[i]).alias(f"z{i}") for i in range(n)]).collect():
        count[r[0], r[1]], total[r[0], r[1]] = r[2], r[3:]
    center = np.arange(-edge, edge + 1) * BIN
    lost = 1 / (1 + np.exp(center[:, None] - center[None, :]))       # P(poor one of bin j preferred to good one of bin i)
    turn = lost * (1 - lost)
    pairs = count[0].sum() * count[1].sum()
    gradient = ((lost.T @ count[1]) @ total[0] - (lost @ count[0]) @ total[1]) / pairs + PENALTY * model.weights
    weight = np.stack([turn.T @ count[1], turn @ count[0]])
    own = sum(np.array(r["z"]).reshape(n, n) for r in rows.mapInPandas(
        partial(_curvature, model, weight), "z array<double>").collect())
    cross = total[1].T @ turn @ total[0]
    hessian = (own - cross - cross.T) / pairs + PENALTY * np.eye(n)
    return np.linalg.solve(hessian, -gradient)


def order_statistic(values: DataFrame, k: int) -> float:
    """The k-th smallest (from 0) of the one column's numbers: counts in ever narrower ranges."""
    s = F.col(values.columns[0])
    low, high = values.agg(F.min(s), F.max(s)).first()
    while low < high:
        place = F.least(F.floor((s - F.lit(low)) / F.lit(high - low) * CUTS), F.lit(CUTS - 1)).alias("place")
        found = values.where(s.between(low, high)).groupBy(place).agg(
            F.count(F.lit(1)).alias("n"), F.min(s).alias("low"), F.max(s).alias("high")).collect()
        for r in sorted(found, key=lambda r: r["place"]):
            if k < r["n"]:
                break
            k -= r["n"]
        low, high = r["low"], r["high"]
    return low


def train(known: DataFrame, labels: DataFrame) -> Ranking | None:
    """A ranking from (doc_id, x) as ``featured`` gives it and (doc_id, label)."""
    spark = known.sparkSession
    ready(spark)
    with scratch() as paths:
        labels = labels.where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label")).distinct()
        rows = cut(known.where("x is not null").join(labels, "doc_id").select("label", "x"), "quality-training")
        try:
            return _ranking(rows)
        finally:
            remove(spark, paths)


def _ranking(rows: DataFrame) -> Ranking | None:
    n = len(FEATURES)
    x = [F.col("x")[i] for i in range(n)]
    facts = rows.agg(F.count(F.lit(1)), F.sum(1 - F.col("label")),
                     *[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first()
    total, poor = facts[0], facts[1]
    if not poor or poor == total:
        return None
    # Rounded, so that the order in which numbers were added up doesn't show.
    mean, scale = np.round(facts[2:2 + n], 9), np.round(facts[2 + n:], 9) + 1e-6
    model = Ranking(mean, scale, np.zeros(n), 0.0)
    for _ in range(STEPS):
        step = _step(rows, model)
        model.weights = np.round(model.weights + step, 9)
        if np.abs(step).max() < 1e-3:
            break
    scores = rows.select(_strength(mean, scale, model.weights).alias("s"))
    at = poor / total * (total - 1)
    # The quantile lies between two training scores; half way is farthest from both.
    ends = {order_statistic(scores, k) for k in {math.floor(at), math.ceil(at)}}
    model.threshold = float(sum(ends) / len(ends))
    return model


def score(known: DataFrame, model: Ranking | None) -> DataFrame:
    """(doc_id, x) as ``featured`` gives it -> (doc_id, score)."""
    if model is None:
        return known.select("doc_id", F.lit(0.0).alias("score"))
    z = _strength(model.mean, model.scale, model.weights) - F.lit(model.threshold - float(np.log(CUTOFF / (1 - CUTOFF))))
    return known.select("doc_id", (1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))).alias("score"))


def held_out(column: str = "doc_id"):
    return F.coalesce(bucket_of(column, 5) == 0, F.lit(False))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    known = featured(docs)
    model = train(known, labels.where(~held_out()).select("doc_id", F.col("quality").alias("label")))
    return score(known, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= CUTOFF, 1).otherwise(0).alias("predicted"))
