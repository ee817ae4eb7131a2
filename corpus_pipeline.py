"""Corpus pipeline: language, exact copies, near copies, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``.  All stages but the last return the columns of ``documents``.
The stages accept null and empty texts, repeated rows, empty tables and further columns, as their
operators state.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import bpe, exact_dedup, langid, mixing, near_dedup
from ratewise.llm.common import prepare, store


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without a text or a letter go."""
    prepare(spark)
    return langid.keep_known(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the largest doc_id."""
    prepare(spark)
    return exact_dedup.drop_exact_duplicates(docs, keep="largest")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates, that of the smallest doc_id."""
    prepare(spark)
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in training order."""
    prepare(spark)
    return mixing.training_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of what they decode to."""
    prepare(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    done = docs.select("doc_id", "lang", "source", bpe.encoded(spark, "text", path).alias("r"))
    return done.select("doc_id", "lang", "source", F.size("r.ids").cast("long").alias("n_tokens"), F.col("r.ids").alias("ids"),
                       F.sha2(F.array_join("r.ids", " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("r.decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mix_sources", mix_sources),
    ("bpe_tokens", tokens),
]

ORACLE_SQL = None           # SQL expresses neither the language model nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
