"""The corpus pipeline, stage by stage, against a brute-force version."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import sentencepiece
from test_llm_methods import brute_components, edited_groups

import corpus_pipeline
from strata.llm import suffix_dedup
from strata.llm.queries import PIECE_MODEL

PASSAGE = "this passage is long enough to be cut out wherever it is found again, as it has well over a hundred bytes in all"


def corpus(rng):
    """Near copies, a passage that repeats, a benchmark item, texts without letters."""
    texts = edited_groups(rng, groups=4, copies=9, words=60)
    texts += [f"opening {i} {rng.random()} {PASSAGE} closing {rng.random()} {i}" for i in range(6)]
    items = [" ".join(f"item{i}word{k}" for k in range(20)) for i in range(3)]
    texts += [items[1], "first some other words " + items[2] + " and then some more", "1234 5678", "!!! ...", "", None]
    return [(i * 3 % 101, t, "aa" if t and any(c.isalpha() for c in t) else None) for i, t in enumerate(texts)], items


def cut_out(texts: dict[int, str]) -> dict[int, str]:
    seen, out = set(), {}
    for i in sorted(texts):
        raw = texts[i].encode()
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - suffix_dedup.LENGTH + 1):
            window = raw[at:at + suffix_dedup.LENGTH]
            if window in seen:
                gone[at:at + suffix_dedup.LENGTH] = True
            seen.add(window)
        out[i] = bytes(b for b, g in zip(raw, gone) if not g).decode()
    return out


def contaminated(text: str, items: list[str]) -> bool:
    words, hit = "".join(c if c.isalnum() else " " for c in text.lower()).split(), set()
    for item in items:
        own = item.split()
        windows = {tuple(own[s:s + 13]) for s in range(len(own) - 12)}
        for at in range(len(words) - 12):
            if tuple(words[at:at + 13]) in windows:
                hit.update(range(at, at + 13))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_stages_against_brute_force(spark, tmp_path):
    rows, items = corpus(random.Random(21))
    docs = spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")

    kept = {i: t for i, t, _ in sorted(rows) if t and any(c.isalpha() for c in t)}
    found = brute_components(list(kept.values()))
    after = [kept]
    after.append({i: t for k, (i, t) in enumerate(kept.items()) if found[k] == k})
    after.append(cut_out(after[-1]))
    after.append({i: t for i, t in after[-1].items() if not contaminated(t, items)})
    assert len(after[0]) > len(after[1]) > len(after[3]) and after[1] != after[2]

    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, after):
        path = f"{tmp_path}/{name}"
        stage(spark, at, str(tmp_path)).write.parquet(path)
        at = spark.read.parquet(path)
        got = at.collect()
        assert at.columns == docs.columns
        assert {r["doc_id"]: r["text"] for r in got} == want and len(got) == len(want), name
        assert all(r["n_chars"] == len(r["text"]) for r in got)

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    tokens = {i: sp.encode(t) for i, t in after[-1].items()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {(i, len(x), sha(",".join(map(str, x))), sha(sp.decode(x))) for i, x in tokens.items()}
    assert {tuple(r) for r in corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).collect()} == want
    assert {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == want
