"""Each operator's method against a brute-force version on small inputs."""

from __future__ import annotations

import itertools
import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from strata.llm import (
    chat_format,
    decontamination,
    hamming_index,
    language_id,
    minhash_dedup,
    quality,
    suffix_dedup,
    toxicity,
    url_filter,
)
from strata.llm.components import components
from strata.llm.queries import PIECE_MODEL
from strata.llm.sentencepiece_codec import Codec
from strata.llm.suffix_sort import deep_shallow

VOCABULARY = [f"w{i}" for i in range(3000)]


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def edited_groups(rng, groups=6, copies=14, words=90):
    """Texts with copies of which more and more words are changed."""
    texts = []
    for _ in range(groups):
        base = [rng.choice(VOCABULARY) for _ in range(words)]
        for c in range(copies):
            own = list(base)
            for _ in range(c % 7):
                own[rng.randrange(words)] = rng.choice(VOCABULARY)
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return texts


def brute_components(texts):
    sets = [set(minhash_dedup.shingle_hashes(t).tolist()) for t in texts]
    at = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and at[a] != at[b]:
            low, high = sorted((at[a], at[b]))
            at = [low if x == high else x for x in at]
    return at


@pytest.mark.parametrize("hot", [minhash_dedup.HOT_MEMBERS, 3])
def test_near_duplicates(spark, monkeypatch, hot):
    monkeypatch.setattr(minhash_dedup, "HOT_MEMBERS", hot)
    texts = edited_groups(random.Random(4))
    got = minhash_dedup.near_duplicates(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == brute_components(texts)


def test_pairs_of_a_bucket():
    rng = random.Random(12)
    texts = edited_groups(rng, groups=2, copies=40)
    low = [minhash_dedup.minima(minhash_dedup.shingle_hashes(t)) for t in texts]
    bands = np.stack([minhash_dedup.band_keys(x) for x in low]).view(np.int64)
    planes = np.stack([minhash_dedup.packed(x) for x in low]).view(np.uint64)
    component = np.array([rng.randrange(30) for _ in texts])
    least = minhash_dedup.NEED / minhash_dedup.OF - minhash_dedup.MARGIN
    found = Counter()
    for key in np.unique(bands):
        own = np.flatnonzero((bands == key).any(axis=1))
        a, b = minhash_dedup._likely_pairs(int(key), own, component[own], bands[own], planes[own])
        found.update(zip(a.tolist(), b.tolist()))
    want = set()
    for b, a in itertools.combinations(range(len(texts)), 2):
        differ = np.bitwise_count(np.bitwise_or(*np.split(planes[a] ^ planes[b], 2))).sum()
        estimate = (1 - differ / minhash_dedup.K - 0.25) / 0.75
        if component[a] != component[b] and (bands[a] == bands[b]).any() and estimate >= least:
            want.add((a, b))
    assert set(found) == want and set(found.values()) == {1}


def template_texts(rng, n, shared=300, own=66):
    """Texts of one template and words of their own: pairwise at about 0.70, not linked."""
    base = [rng.choice(VOCABULARY) for _ in range(shared)]
    return [" ".join(base + [f"t{i}w{j}" for j in range(own)]) for i in range(n)]


def test_memory_of_a_hot_bucket():
    texts = template_texts(random.Random(14), 900)
    low = [minhash_dedup.minima(minhash_dedup.shingle_hashes(t)) for t in texts]
    bands = np.stack([minhash_dedup.band_keys(x) for x in low]).view(np.int64)
    planes = np.stack([minhash_dedup.packed(x) for x in low]).view(np.uint64)
    keys, counts = np.unique(bands, return_counts=True)
    key = int(keys[counts.argmax()])
    own = np.flatnonzero((bands == key).any(axis=1))
    tracemalloc.start()
    try:
        minhash_dedup._likely_pairs(key, own, own, bands[own], planes[own])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    pairs = len(own) * (len(own) - 1) // 2
    assert len(own) > 200 and peak < 150 * pairs


def test_template_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "HOT_MEMBERS", 20)
    rng = random.Random(15)
    texts = template_texts(rng, 120)
    for i in range(0, 120, 30):   # four of them have a near copy
        words = texts[i].split()
        texts.append(" ".join([*words[:-2], "other", words[-1]]))
    docs = docs_of(spark, texts)
    got = minhash_dedup.near_duplicates(docs).orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == brute_components(texts) and got[120]["component_id"] == 0

    rows = minhash_dedup.sketch(docs).selectExpr("doc_id as rep", "n_shingles", "explode(bands) as key").selectExpr(
        "key", "rep", "n_shingles", "rep as component").cache()
    sizes = {r["key"]: r["count"] for r in rows.groupBy("key").count().where("count > 1").collect()}
    groups: dict = {}
    for r in minhash_dedup._blocks(rows).collect():
        groups.setdefault((r["key"], r["i"], r["j"]), []).append((r["block"], r["rep"]))
    met = Counter()
    for (key, i, j), held in groups.items():
        met.update((key, *sorted((x, y))) for a, x in held for b, y in held
                   if (a, b) == (i, j) and (x < y if i == j else True))
    assert max(sizes.values()) > 60 and max(map(len, groups.values())) <= 4 * 20
    assert set(met.values()) == {1} and len(met) == sum(n * (n - 1) // 2 for n in sizes.values())


def test_short_texts_at_the_threshold(spark):
    """Pairs of 3 to 16 shingles at exactly 0.75."""
    texts = []
    for i in range(240):
        both = (3, 6, 9, 12)[i % 4]
        words = [f"p{i}w{j}" for j in range(both + both // 3 + 4)]
        texts += [" ".join(words[:both + 4]), " ".join(words)]
    want = brute_components(texts)
    assert want == [i - i % 2 for i in range(len(texts))]
    got = minhash_dedup.near_duplicates(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == want


def test_estimate_is_near_the_similarity(spark):
    rng = random.Random(1)
    base = [rng.choice(VOCABULARY) for _ in range(400)]
    a, b = " ".join(base), " ".join(base[:330] + [rng.choice(VOCABULARY) for _ in range(70)])
    x, y = (minhash_dedup.shingle_hashes(t) for t in (a, b))
    both = len(np.intersect1d(x, y))
    pair = spark.createDataFrame([tuple(minhash_dedup.packed(minhash_dedup.minima(h)).tolist() for h in (x, y))],
                                 "a array<long>, b array<long>")
    estimate = pair.select(minhash_dedup.estimate("a", "b")).first()[0]
    assert abs(estimate - both / (len(x) + len(y) - both)) < minhash_dedup.MARGIN


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(None, 3), (200, 201), (202, 201), (203, 202)]
    at = {i: i for e in edges if None not in e for i in e}
    for _ in range(60):
        for a, b in edges:
            if a is not None:
                at[a] = at[b] = min(at[a], at[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {i for a, b in edges if a is not None and a != b for i in (a, b)}
    assert sorted((r["id"], r["component"]) for r in got) == sorted((i, at[i]) for i in linked)


def test_deep_shallow_order():
    rng = random.Random(3)
    for _ in range(120):
        groups = np.sort([rng.randint(0, 3) for _ in range(rng.randint(1, 50))])
        bases = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 90))) for _ in range(3)]
        strings = [rng.choice(bases)[:rng.randint(0, 90)] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 4))) for _ in groups]
        order, lcp = deep_shallow(strings, groups)
        assert sorted(order.tolist()) == list(range(len(groups))) and (groups[order] == groups).all()
        for i in range(1, len(groups)):
            a, b = strings[order[i - 1]], strings[order[i]]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[i] == (same if groups[i] == groups[i - 1] else -1)
            assert groups[i] != groups[i - 1] or a <= b or a.rstrip(b"\0") == b.rstrip(b"\0")


def brute_removed(texts, length=suffix_dedup.LENGTH):
    seen, out = set(), []
    for t in texts:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if raw[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(raw[i:i + length])
        out.append(int(gone.sum()))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_FORMS, 1])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_FORMS", hot)
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcdeé ") for _ in range(n)) for n in (99, 100, 101, 150, 400)] + ["ab" * 120, "x" * 300]
    texts = ["".join(rng.choice("klmnoü ") for _ in range(rng.randint(0, 120))) + rng.choice(passages)
             + "".join(rng.choice("klmnoü ") for _ in range(rng.randint(0, 60))) + rng.choice(passages)[rng.randint(0, 30):]
             for _ in range(60)]
    got = suffix_dedup.report(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in got] == brute_removed(texts)
    cleaned = suffix_dedup.without_repeats(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert all(len(c["text"].encode()) <= r["n_bytes"] - r["n_removed"] for c, r in zip(cleaned, got))


def test_short_and_long_items(spark):
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80))) for _ in range(40)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (1, 2, 3, 4, 5)] + [
        " ".join(texts[i].split()[a:a + n]) for i, a, n in ((3, 1, 13), (5, 0, 14), (7, 2, 30), (9, 3, 12), (9, 1, 7), (11, 0, 8))] + [""]
    got = decontamination.contamination(docs_of(spark, texts), spark.createDataFrame(
        list(enumerate(items)), "item_id long, text string")).orderBy("doc_id").collect()
    for text, row in zip(texts, got):
        words, hit, found = text.split(), set(), set()
        for i, item in enumerate(items):
            own = item.split()
            n = min(13, len(own))
            for s in range(len(own) - n + 1) if own else ():
                for at in range(len(words) - n + 1):
                    if words[at:at + n] == own[s:s + n]:
                        hit.update(range(at, at + n))
                        found.add(i)
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (len(words), len(hit), len(found))


@pytest.mark.parametrize("chunk", [4096, 5])
def test_repetitive_texts(spark, monkeypatch, chunk):
    """Windows that begin at every place, in both texts, and spans over chunk borders."""
    monkeypatch.setattr(decontamination, "CHUNK", chunk)
    texts = ["a " * 300, "a b " * 90, "a b c " * 40 + "x " + "a " * 12, "x y " * 3, "b " * 13 + "q " * 500]
    items = ["a " * 50, "b a " * 20, "a " * 13, "x y x", "b", "q " * 12]
    got = decontamination.contamination(docs_of(spark, texts), spark.createDataFrame(
        list(enumerate(items)), "item_id long, text string")).orderBy("doc_id").collect()
    for text, row in zip(texts, got):
        words, hit, found = text.split(), set(), set()
        for i, item in enumerate(items):
            own = item.split()
            n = min(13, len(own))
            windows = {tuple(own[s:s + n]) for s in range(len(own) - n + 1)}
            for at in range(len(words) - n + 1):
                if tuple(words[at:at + n]) in windows:
                    hit.update(range(at, at + n))
                    found.add(i)
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (len(words), len(hit), len(found))


def test_one_word_a_hundred_thousand_times(spark):
    """Time and rows grow with the texts, not with the product of their repeats."""
    texts = ["a " * 100_000, "a b " * 50_000, "c " * 100_000]
    items = ["a " * 300, "b a " * 150]
    began = time.monotonic()
    got = decontamination.contamination(docs_of(spark, texts), spark.createDataFrame(
        list(enumerate(items)), "item_id long, text string")).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_hit"], r["n_items"]) for r in got] == [(100_000, 100_000, 1), (100_000, 100_000, 1), (100_000, 0, 0)]
    assert time.monotonic() - began < 60


def test_pieces_like_the_library():
    sp, own = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL), Codec(PIECE_MODEL, cache_words=50)
    rng = random.Random(7)
    parts = ["a", "b", "e", "t", " ", "  ", "\n", "\t", "é", "ß", "1", "中", "。", "\U0001f600", "the", "ing", "tion", "▁", "́", ".", ",", "'", "A", "<s>", "<0x0A>", "\0"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids = sp.encode(text)
        assert own.encode(text) == ids and own.decode(ids) == sp.decode(ids)
        loose = [rng.randrange(32000) for _ in range(6)] + [rng.randrange(3, 259) for _ in range(3)]
        assert own.decode(loose) == sp.decode(loose)
    assert own.encode("x" * 5000) == sp.encode("x" * 5000)


def test_forward_backward():
    rng = np.random.default_rng(1)
    k = 3
    for _ in range(15):
        lengths = np.sort(rng.integers(1, 5, 4))[::-1]
        emit, move, start = rng.random((lengths.sum(), k)) + 0.1, rng.random((k, k)) + 0.1, rng.random(k) + 0.1
        got, at = language_id.forward_backward(emit, move, start, lengths), 0
        for n in lengths.tolist():
            want = np.zeros((n, k))
            for y in itertools.product(range(k), repeat=n):
                p = start[y[0]] * emit[at, y[0]]
                for t in range(1, n):
                    p *= move[y[t - 1], y[t]] * emit[at + t, y[t]]
                want[range(n), y] += p
            assert np.allclose(want / want.sum(axis=1, keepdims=True), got[at:at + n])
            at += n


def test_tasks_forget_what_other_operators_remember():
    field = language_id.fit([("aaa bab aba", "aa"), ("xyx yyx xxy", "xx")] * 5)
    first = language_id.judge(field, ["aba yyx"])
    assert language_id._memory["words"] and language_id._buckets
    assert list(minhash_dedup._sketch(iter([]))) == []
    assert not language_id._memory["words"] and not language_id._buckets
    assert language_id.judge(field, ["aba yyx"]) == first


def test_code_switching():
    rng = random.Random(8)
    tongues = {"xx": ["ka", "ko", "ki", "ku"], "yy": ["le", "lo", "la", "lu"]}
    word = lambda y: "".join(rng.choice(tongues[y]) for _ in range(3))
    model = language_id.fit([(" ".join(word(y) for _ in range(40)), y) for y in ("xx", "yy") for _ in range(30)])
    mixed = [word("xx") for _ in range(12)] + [word("yy") for _ in range(12)]
    labels = language_id.label_chains(model, [mixed])[0].argmax(axis=1)
    assert [model.labels[i] for i in labels] == ["xx"] * 12 + ["yy"] * 12


def test_subsequence_kernel():
    def subsequences(word):
        c, out = [x for x in toxicity._codes([word])[0] if x], Counter()
        for i, j, k in itertools.combinations(range(len(c)), 3):
            if k - i < toxicity.SPAN:
                out[c[i], c[j], c[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    def kernel(a, b):
        a, b = subsequences(a), subsequences(b)
        dot = lambda p, q: sum(v * q[x] for x, v in p.items())
        return dot(a, b) / max(1e-12, (dot(a, a) * dot(b, b)) ** 0.5)

    words = ["idiot", "id.iot", "i-d-i-o-t", "banana", "anananana", "élève", "xy", "stupidly"]
    assert np.allclose(toxicity.kernel(words, words), [[kernel(a, b) for b in words] for a in words])


def test_insults_with_gaps():
    rng = random.Random(9)
    plain = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(600)]
    bad = ["dumbkopf", "grotvex", "zwickmop"]
    sentence = lambda *x: " ".join([*(rng.choice(plain) for _ in range(8)), *x, *(rng.choice(plain) for _ in range(4))])
    texts = [(". ".join(sentence() for _ in range(3)), 0) for _ in range(150)]
    texts += [(". ".join([sentence(), sentence(rng.choice(bad)), sentence()]), 1) for _ in range(60)]
    model = toxicity.fit(texts)
    score = lambda t: float(model.score(toxicity.text_margins(model, [t]))[0])
    for w in ("grotvex", "grot.vex", "Grotvexx", "d-umbkopf", "z w i c k m o p"):
        assert score(sentence(w)) >= 0.5, w
    assert sum(score(sentence()) >= 0.5 for _ in range(100)) <= 2 and score("") < 0.5


def test_ranking_has_no_gradient_left():
    """The weights are where the penalised loss of all pairs can't fall: its gradient is
    zero there by plain sums over the pairs, and moving off raises it."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 3))
    label = (x @ [1.0, -2.0, 0.5] + rng.standard_normal(60) > 0).astype(int)
    model = quality.fit(x, label)
    z = np.clip((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6), -8, 8)
    again = np.random.default_rng(5)
    good, poor = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    pairs = list(zip(again.choice(good, quality.PAIRS), again.choice(poor, quality.PAIRS)))
    d = np.array([z[a] - z[b] for a, b in pairs])

    def loss(w):
        return np.log1p(np.exp(-(d @ w))).mean() + quality.PENALTY / 2 * (w @ w)

    slope = sum(-v / (1 + np.exp(v @ model.weights)) for v in d) / len(d) + quality.PENALTY * model.weights
    assert np.abs(slope).max() < 1e-8
    assert all(loss(model.weights) < loss(model.weights + step) for step in 0.05 * rng.standard_normal((20, 3)))


def test_a_preference_is_learned_as_often_as_it_is_held():
    """One feature, two kinds of text: the odds of the model are those of the pairs."""
    x = np.array([[0.0]] * 30 + [[1.0]] * 10 + [[0.0]] * 10 + [[1.0]] * 30)
    label = np.array([0] * 40 + [1] * 40)
    model = quality.fit(x, label)
    gap = 1 / model.scale[0] * model.weights[0]            # strength of 1 over 0
    wins = 30 * 30 / (30 * 30 + 10 * 10)                  # of the pairs that differ, those that prefer 1
    assert abs(1 / (1 + np.exp(-gap)) - wins) < 0.02


def test_nystroem_features_are_the_kernel():
    """With every word a landmark, products of the whitened features are the plain kernel,
    and a machine's table gives the same margins as sums of kernel values."""
    words = ["stupid", "stoopid", "s1upid", "table", "chair", "idiot", "window", "idi0t"]

    def plain(a, b):
        def vector(w):
            out = Counter()
            code = toxicity._codes([w])[0]
            for i, j, k in itertools.combinations(range(len(w)), 3):
                if k - i < toxicity.SPAN:
                    out[code[i], code[j], code[k]] += toxicity.DECAY ** (k - i + 1)
            return out
        x, y = vector(a), vector(b)
        dot = lambda p, q: sum(v * q[t] for t, v in p.items())
        return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y))

    want = np.array([[plain(a, b) for b in words] for a in words])
    own = toxicity.kernel(words, words)
    assert np.allclose(own, want)
    value, vector = np.linalg.eigh(own)
    good = value > 1e-6 * value.max()
    features = own @ vector[:, good] / np.sqrt(value[good])
    assert np.allclose(features @ features.T, want, atol=1e-5)
    alpha = np.linspace(-1, 1, len(words))
    machine = toxicity.Machine(toxicity._table(words, alpha), 0.25, 1.0, 0.0)
    assert np.allclose(machine.margins(words), want @ alpha + 0.25)


def test_machine_is_a_squared_hinge_minimum():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((80, 4))
    y = np.where(x @ [1.0, -1.0, 0.5, 0.0] + 0.3 + 0.4 * rng.standard_normal(80) > 0, 1.0, -1.0)
    cost = np.full(80, 1 / 80)
    w, b = toxicity.hinge(x, y, cost)
    loss = lambda w, b: (cost * np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum() + 5e-5 * (w @ w)
    least = loss(w, b)
    assert all(least <= loss(w + s[:4], b + s[4]) + 1e-9 for s in 0.02 * rng.standard_normal((60, 5)))


def test_long_runs_are_scored_in_windows():
    run = "ab" * 400 + "stupid" + "cd" * 400
    windows = toxicity.words_of(f"{run} short")
    assert windows[-1] == "short" and all(len(w) <= toxicity.RUN for w in windows)
    assert "".join(w[:toxicity.RUN // 2] for w in windows[:-1]) + windows[-2][toxicity.RUN // 2:] == run
    assert any("stupid" in w for w in windows[:-1])
    tracemalloc.start()
    machine = toxicity.Machine(np.zeros(toxicity.ALPHABET**3), 0.5, 1.0, 0.0)
    assert toxicity.text_margins(machine, ["x1" * 500_000])[0] == 0.5
    assert tracemalloc.get_traced_memory()[1] < 400e6
    tracemalloc.stop()


def test_ranking_of_all_labelled_texts(spark):
    """The distributed fit is the minimum over all pairs of a good and a poor text, each
    labelled text counts, and the threshold is the plain quantile."""
    rng, n = np.random.default_rng(4), len(quality.FEATURES)
    x = rng.standard_normal((300, n))
    label = (x @ rng.standard_normal(n) + 2 * rng.standard_normal(300) > -1).astype(int)
    known = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None)], "doc_id long, x array<double>")
    labels = spark.createDataFrame([*enumerate(label.tolist()), (900, 1), (901, 0), (None, 1)], "doc_id long, label int")
    model = quality.train(known, labels)
    z = np.clip((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6), -8, 8)
    d = (z[label == 1][:, None, :] - z[label == 0][None, :, :]).reshape(-1, n)
    slope = -(d / (1 + np.exp(d @ model.weights))[:, None]).mean(axis=0) + quality.PENALTY * model.weights
    assert np.abs(slope).max() < 1e-3
    s = model.strength(x)
    assert abs(model.threshold - np.quantile(s, (label == 0).mean(), method="midpoint")) < 1e-9
    got = dict(quality.score(known, model).collect())
    assert all(abs(got[i] - v) < 1e-9 for i, v in enumerate(model.score(x)))
    assert abs(got[900] - model.score(np.zeros((1, n)))[0]) < 1e-9
    assert quality.train(known, labels.where("label = 1")) is None


def test_order_statistics(spark):
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.standard_normal(500), np.full(400, 0.25), [1e12, -1e-300]])
    df = spark.createDataFrame([(float(v),) for v in values], "s double")
    for k in (0, 1, 250, 600, 900, 901):
        assert quality.order_statistic(df, k) == np.sort(values)[k]


def test_ranking_threshold():
    rng = np.random.default_rng(2)
    label = (np.arange(400) % 5 > 0).astype(int)
    x = rng.standard_normal((400, 4)) + label[:, None] * np.array([3.0, -3.0, 1.0, 0.0])
    model = quality.fit(x, label)
    score = model.score(x)
    assert abs((score < quality.CUTOFF).mean() - 0.2) < 0.01 and ((score >= quality.CUTOFF) == label).mean() > 0.95


def test_probing_finds_every_code():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, 32))
    codes = hamming_index.fit(x, 10)
    own = codes.of(x)
    index = hamming_index.Index(own)
    for radius in (0, 3, 9, 12):
        found = index.within(own[:50], radius)
        assert (found == (np.stack([hamming_index.distances(c, own) for c in own[:50]]) <= radius)).all()


def test_shards_change_nothing_but_the_search(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 16))
    x = centres[np.arange(300) % 6] + 0.3 * rng.standard_normal((300, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    search = lambda: [tuple(r) for r in hamming_index.nearest(table, "vec_id % 10 = 0", 5).orderBy("query_id", "rank").collect()]
    whole = search()
    monkeypatch.setattr(hamming_index, "SHARD_ROWS", 60)
    monkeypatch.setattr(hamming_index, "BLOCK_ROWS", 7)
    dealt = search()
    assert len(whole) == len(dealt) == 150
    hits = sum(v == w for (_, _, _, v), (_, _, _, w) in zip(whole, dealt))
    assert hits >= 140


def test_events_fold(spark):
    rows = [(1, 1, 1, "message", "user", "hi"), (1, 2, 2, "delta", "assistant", "He"), (1, 3, 2, "delta", None, "llo"),
            (1, 4, 1, "edit", None, "hi there"), (1, 5, 2, "regenerate", None, ""), (1, 6, 2, "delta", None, "Good "),
            (1, 7, 2, "delta", None, "day"), (1, 8, 2, "reaction", None, "+1"), (2, 1, 1, None, "user", None)]
    events = spark.createDataFrame(rows, "conv_id long, seq long, message long, kind string, role string, text string")
    got = {tuple(r) for r in chat_format.fold(events).collect()}
    assert got == {(1, 1, "user", "hi there"), (1, 2, "assistant", "Good day"), (2, 1, "user", "")}


def test_escapes_are_reversible(spark):
    rng = random.Random(10)
    texts = ["".join(rng.choice(["\\", "<", "|", "<|im_end|>\n", "s", "p", "l", "\n", "a"]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    safe = df.select("t", chat_format.escape(df["t"], chat_format.ROLE_ESCAPES).alias("e"))
    rows = safe.select("t", "e", chat_format.unescape(safe["e"], chat_format.ROLE_ESCAPES).alias("b")).collect()
    assert all(r["b"] == r["t"] and "<|" not in r["e"] and "\n" not in r["e"] for r in rows)


def test_ranks(spark):
    edges = [("a.x", "b.x", 2.0), ("a.x", "c.x", 1.0), ("b.x", "c.x", 1.0), ("c.x", "a.x", 3.0), ("d.x", "c.x", 1.0)]
    seeds = [("a.x", True, False), ("d.x", False, True), ("c.x", False, True)]
    got = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.propagate(
        spark.createDataFrame(edges, "src string, dst string, weight double"),
        spark.createDataFrame(seeds, "host string, trusted boolean, blocked boolean")).collect()}
    hosts = sorted({h for s, d, _ in edges for h in (s, d)})
    for side, start in ((0, {"a.x"}), (1, {"d.x", "c.x"})):
        ways = [(s, d, w) if side == 0 else (d, s, w) for s, d, w in edges]
        out = Counter()
        for s, _, w in ways:
            out[s] += w
        rank = {h: float(h in start) for h in hosts}
        for _ in range(url_filter.ROUNDS):
            new = {h: (1 - url_filter.DAMPING) * (h in start) for h in hosts}
            for s, d, w in ways:
                new[d] += url_filter.DAMPING * rank[s] * w / out[s]
            rank = new
        assert all(abs(got.get(h, (0, 0))[side] - rank[h]) < 1e-9 for h in hosts)


def test_ranks_converge(spark):
    """A blocked seed with three siblings, a chain of links to a blocked host, and many
    seeds whose ranks meet at one host."""
    family = [e for i in range(4) for e in ((f"s{i}.f.x", "f.x", 1.0), ("f.x", f"s{i}.f.x", 1.0))]
    chain = [(f"h{i + 1}.x", f"h{i}.x", 1.0) for i in range(15)]
    crowd = [e for i in range(40) for e in (("hub.y", f"c{i}.y", 1.0), (f"c{i}.y", "hub.y", 1.0))]
    edges = family + chain + crowd
    blocked = ["s0.f.x", "h0.x", *(f"c{i}.y" for i in range(40))]
    got = {r["host"]: r["distrust"] for r in url_filter.propagate(
        spark.createDataFrame(edges, "src string, dst string, weight double"),
        spark.createDataFrame([(h, False, True) for h in blocked], "host string, trusted boolean, blocked boolean")).collect()}
    hosts = sorted({h for s, d, _ in edges for h in (s, d)})
    at = {h: i for i, h in enumerate(hosts)}
    move = np.zeros((len(hosts), len(hosts)))
    for s, d, w in edges:
        move[at[s], at[d]] += w
    move /= np.maximum(move.sum(axis=0), 1e-300)
    start = np.array([h in blocked for h in hosts]) * (1 - url_filter.DAMPING)
    want = np.linalg.solve(np.eye(len(hosts)) - url_filter.DAMPING * move, start)
    assert max(abs(got.get(h, 0.0) - want[at[h]]) for h in hosts) < url_filter.LEFT
    assert got["s1.f.x"] < url_filter.BLOCK_AT and got["h10.x"] < got["h9.x"] < url_filter.BLOCK_AT


def test_names_under_a_public_suffix_are_parties_of_their_own(spark):
    """Ten hosts under co.uk (and github.io) with three blocked by rule: none of the others
    is; under one registered domain they are."""
    rules = (("h0.", "/", "block"), ("h1.", "/", "block"), ("h2.", "/", "block"))
    for domain, blocked in (("co.uk", 0), ("github.io", 0), ("one-party.co.uk", 7), ("party.info", 7)):
        pages = spark.createDataFrame([(i, f"http://h{i}.{domain}/p", None) for i in range(10)], "page_id long, url string, html string")
        got = url_filter.verdicts(pages, tuple((h + domain, p, v) for h, p, v in rules)).collect()
        assert sum(r["verdict"] == "block" for r in got if r["rule"] is None) == blocked, domain


def test_only_what_is_read_is_left(spark):
    import os

    from strata.session import ensure_checkpoint_dir
    folder = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "strata")
    before = set(os.listdir(folder))
    pages = spark.createDataFrame([(1, "http://a.b.net/x", "<a href=//c.org>"), (2, "http://c.org/fr/", None)], "page_id long, url string, html string")
    assert url_filter.verdicts(pages).count() == 2
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} <= {"hosts", "host-rules", "host-scores"}


def test_links_carry_verdicts(spark):
    page = lambda i, url, *to: (i, url, "".join(f'<a href="https://{t}/x">t</a>' for t in to))
    pages = spark.createDataFrame([
        page(1, "http://bad.net/a", "victim.info"), page(2, "http://friend.info/a", "bad.net"), page(3, "http://other.info/a"),
        page(4, "http://good.org/fr/a", "friend.info"), page(5, "http://victim.info/a")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.verdicts(pages).collect()}
    assert got[1] == ("net/", "block") and got[4] == ("org/fr/", "allow")
    assert got[3] == (None, "allow") and got[5] == (None, "allow")  # a link from a blocked host says nothing of its target
    assert got[2][0] is None
