"""A corpus pipeline over ``documents``: each stage calls one operator of ``market_lens.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result to the shared folder as Parquet and reads it again for the next, so a lost executor
costs a re-read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from market_lens.llm import chunk_dedup, decontaminate, lang_crf, piece_bpe, simhash
from market_lens.llm.common import table
from market_lens.sources.scratch import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in which no language has two fifths of the words, go."""
    return lang_crf.confident(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs, words=3, distance=3)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that another document keeps are cut out of the text."""
    cut = chunk_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sizes and digests of the texts' tokens."""
    return piece_bpe.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: A trained model, XXH64 and the tokenizer can't be stated in SQL; tests run a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
