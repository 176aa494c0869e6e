"""A training corpus from ``documents``: language, copies, repeats, benchmark, tokens.

STAGES are applied in order; each works on all rows that the one before kept, and
all but the last return the columns of ``documents``:

1. language: rows whose language the field can't tell (no letters, or no language
   with LEAST_SHARE of the words) go;
2. near_duplicates: of each group of near copies only the smallest doc_id stays;
3. repeats: byte strings that occur earlier in what is left are cut out of the
   texts (n_chars follows); rows stay, also those whose text gets empty;
4. decontamination: rows that hold too much of the benchmark go;
5. tokens: each row's number of ids and digests of the ids and the decoded text.

A stage's scratch tables go when the next stage begins, as its own result is stored
then (not those that the rows handed on are still read from).

Rows with a null doc_id go through every stage; each stage's own cases (nulls,
empty texts, repeated rows, further columns) are those of its operator.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontamination, language_id, minhash_dedup, sentencepiece_codec, suffix_dedup
from strata.llm.common import cut, read, remove, scratch
from strata.llm.queries import PIECE_MODEL

#: Least share of a text's words in its language.
LEAST_SHARE = 0.3


#: Scratch tables of a stage, by application, input and the stage's place.
_left: dict[tuple[str, str, int], list[str]] = {}


def _stage(place: int):
    def wrap(stage):
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            key = spark.sparkContext.applicationId, sf_dir
            old = _left.pop((*key, place - 1), [])
            if old:
                read_now = docs.inputFiles()
                # Folder names are unique; the way a path is spelt may differ.
                remove(spark, [p for p in old if not any(f"/{p.rsplit('/', 1)[-1]}/" in f for f in read_now)])
            with scratch() as made:
                out = stage(spark, docs, sf_dir)
            _left[*key, place] = made
            return out
        return run_stage
    return wrap


@_stage(1)
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.where(~language_id.held_out()))
    return language_id.accepted(docs, model, LEAST_SHARE)


@_stage(2)
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = minhash_dedup.near_duplicates(docs)
    return docs.join(judged.where(~F.col("kept")).select("doc_id"), "doc_id", "left_anti").select(docs.columns)


@_stage(3)
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


@_stage(4)
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, read(spark, sf_dir, "benchmark"))


@_stage(5)
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip_digests(docs, PIECE_MODEL)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontaminated),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The language field is learned, which SQL can't express: tests/llm holds the
#: stages against brute-force versions instead.
ORACLE_SQL = None
