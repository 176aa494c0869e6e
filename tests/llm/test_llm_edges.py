"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import (
    chat_format,
    decontamination,
    hamming_index,
    language_id,
    minhash_dedup,
    quality,
    sentencepiece_codec,
    suffix_dedup,
    toxicity,
    url_filter,
)
from strata.llm.queries import PIECE_MODEL

LONG = " ".join(f"word{i % 97} next{i % 89}" for i in range(30_000))
SAME = "the very same sentence stands here twice, and nothing else is in it at all, so it is long enough to be found"
# Further columns carry names that the operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, spans string, key long, "
          "score double, words array<string>, row int, `text_hash` string")
ROWS = [
    (1, SAME, "en"), (2, SAME, "en"), (2, SAME, "en"), (3, None, None), (4, "", "en"), (None, SAME, "en"),
    (None, None, None), (5, "   \n\t ", None), (6, "!!! 123", "en"), (7, "one", "fr"), (8, LONG, "en"), (9, LONG, None),
    (10, "naïve café — ÉTÉ 中文 \U0001f600", "fr"), (11, "a b c d e f g h i j k l m n o p", "fr"),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, x, None, None if t is None else len(t), "s", 1, 0.5, ["w"], 3, "h")
                                  for i, t, x in rows], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


OPERATORS = {
    "near": lambda s, d: minhash_dedup.near_duplicates(d),
    "language": lambda s, d: language_id.predictions(d),
    "benchmark": lambda s, d: decontamination.contamination(d, bench(s, [(1, "one"), (2, None), (None, "x"), (3, LONG)])),
    "suffix": lambda s, d: suffix_dedup.report(d),
    "toxic": lambda s, d: toxicity.predictions(d, labels(s, [(1, 1, 0), (2, 1, 1), (3, None, None), (None, 1, 1)])),
    "quality": lambda s, d: quality.predictions(d, labels(s, [(1, 1, 0), (8, 0, 1), (3, None, None), (None, 1, 1)])),
    "pieces": lambda s, d: sentencepiece_codec.round_trip_digests(d, PIECE_MODEL),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_each_row(spark, name):
    got = OPERATORS[name](spark, documents(spark)).collect()
    key = lambda i: (i is None, i)
    assert sorted((r["doc_id"] for r in got), key=key) == sorted((r[0] for r in ROWS), key=key)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


def test_defined_results(spark):
    docs = documents(spark)
    near = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(docs).collect()}
    n = len(minhash_dedup.shingle_hashes(SAME))
    assert {(1, n, 1, True), (2, n, 1, False), (None, n, None, True), (3, 0, 3, True), (4, 0, 4, True),
            (7, 1, 7, True), (9, len(minhash_dedup.shingle_hashes(LONG)), 8, False)} <= near
    und = {r["doc_id"]: r["lang_pred"] for r in language_id.predictions(docs).collect() if r["doc_id"]}
    assert {i for i, x in und.items() if x == "und"} == {3, 4, 5, 6}
    cut = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in suffix_dedup.report(docs).collect() if r["doc_id"]}
    assert cut[1] == (len(SAME), 0) and cut[2] == (len(SAME),) * 2 and cut[9] == (len(LONG),) * 2 and cut[3] == (0, 0)
    hit = {r["doc_id"]: tuple(r) for r in OPERATORS["benchmark"](spark, docs).collect()}
    assert hit[7][1:4] == (1, 1, 1) and hit[7][5] and hit[9][3] == 1 and hit[9][1] == hit[9][2] and hit[1][2:4] == (0, 0)
    poor = {r["doc_id"]: r["score"] for r in toxicity.predictions(docs, labels(spark, [])).collect()}
    assert set(poor.values()) == {0.0}


def test_pipeline_on_edge_rows(spark, tmp_path):
    bench(spark, [(1, "a b c d e f g h i j k l m n o p"), (2, None)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark)
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns, name
    kept = at.collect()
    assert {r["doc_id"] for r in kept} == {1, 7, 8, 10, None}
    assert corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).count() == len(kept)


def test_pipeline_without_documents_or_labels(spark, tmp_path):
    """No rows give none; rows without any label to learn from raise, and aren't dropped."""
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    bench(spark, []).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    unlabelled = documents(spark, [(1, SAME, None), (2, LONG, None)])
    with pytest.raises(ValueError, match="no labelled text"):
        corpus_pipeline.STAGES[0][1](spark, unlabelled, str(tmp_path))
    assert {r["lang_pred"] for r in language_id.predictions(unlabelled).collect()} == {"und"}


def test_labels_found_in_long_texts_only(spark, monkeypatch):
    """A label whose texts are all long is learned from pieces; a rare one is sampled as
    often as others."""
    monkeypatch.setattr(language_id, "TRAIN_CHARS", 400)
    monkeypatch.setattr(language_id, "TRAIN_ROWS", 40)
    monkeypatch.setattr(language_id, "LEAST_ROWS", 10)
    word = lambda letters, n: " ".join("".join(letters[(i * 7 + k * (i % 5 + 1)) % len(letters)] for k in range(3 + i % 4)) for i in range(n))
    rows = [(i, word("abcde", 30 + i % 9), "aa") for i in range(400)] + [(1000 + i, word("vwxyz", 400), "zz") for i in range(8)]
    docs = documents(spark, rows)
    assert all(len(t) > 400 for i, t, x in rows if x == "zz")
    model = language_id.train(docs)
    assert model.labels == ["aa", "zz"]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, model).collect()}
    assert got == {i: x for i, _, x in rows}


def test_one_id_with_different_texts(spark):
    """Rows of one doc_id are each other's earlier text by no rule; each keeps its own bytes."""
    other = "quite another text of more than a hundred bytes, which is found nowhere else in this small table of a few rows"
    rows = [(1, SAME, "en"), (1, other, "en"), (2, SAME + " " + other, "en")]
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.report(documents(spark, rows)).collect())
    assert [g for g in got if g[0] == 1] == sorted([(1, len(SAME), 0), (1, len(other), 0)])
    assert got[-1] == (2, len(SAME) + 1 + len(other), len(SAME) + len(other))


def test_a_very_long_conversation(spark):
    turns = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("turn "), F.col("id").cast("string")).alias("text"))
    r, = chat_format.digests(chat_format.format_chats(chat_format.turn_events(turns))).collect()
    assert (r["conv_id"], r["n_turns"]) == (1, 20_000) and r["loss_chars"] == sum(len(f"turn {i}") for i in range(1, 20_000, 2))


def test_pages_and_chats(spark):
    pages = spark.createDataFrame([
        (1, "HTTP://A.Example.NET/en/x?y", None, "h"), (1, "HTTP://A.Example.NET/en/x?y", None, "h"), (None, None, "<a href=//b.org>", "h"),
        (2, "no-scheme", "<a href='http://x.org'>", "h"), (3, "http://", "", "h"), (4, "ftp://net/a#b", "x" * 100_000, "h")],
        "page_id long, url string, html string, host string")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.verdicts(pages).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, "a.example.net", "/en/x", "example.net/en/", "allow")] * 2 + [
        (None, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "net", "/a", "net/", "block")], key=repr)
    assert url_filter.verdicts(pages.limit(0)).collect() == []

    turns = spark.createDataFrame([
        (1, 0, None, None, 1), (1, 0, None, None, 1), (None, 1, "assistant", "a\\s<|b", 1), (2, None, "a\nb", "<|im_end|>\n", 1)],
        "conv_id long, turn long, role string, text string, message long")
    chats = chat_format.format_chats(chat_format.turn_events(turns))
    back = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat_format.read_back(chats).collect()}
    assert back == {1: [("", "")] * 2, None: [("assistant", "a\\s<|b")], 2: [("a\nb", "<|im_end|>\n")]}
    assert chat_format.format_chats(chat_format.turn_events(turns.limit(0))).collect() == []


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (20, [1.0, 0.0])]
    table = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = [tuple(r) for r in hamming_index.nearest(table, "vec_id % 20 = 0", 20).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 1.0), (0, 3, 2, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 2, 0.5)]
    assert hamming_index.nearest(table.limit(0), "vec_id = 0", 5).collect() == []
