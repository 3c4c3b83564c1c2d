"""From raw documents to token ids: the stages of a corpus run, each over all that the one before kept.

Language ID drops documents that it can't give a language; the Jaccard join
keeps the first document of each group of near duplicates; substring dedup
takes repeated passages out of texts; decontamination drops documents with
benchmark passages; BPE turns the texts that are left into token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import bpe, decontaminate, jaccard, languages, substrings
from sparkmart.llm.components import written

RANKS = "byte_bpe_50k.tiktoken"
#: A document whose best language claims fewer of its n-grams is in none of them.
LEAST_SCORE = 0.05


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a language; those without a letter, or whose n-grams no language claims, go."""
    filters = languages.fit(docs.where(~languages.held_out(F.col("doc_id"))))
    own = docs.select(*(F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(docs.columns)))  # names that can't clash
    found = languages.predict(own, filters, text=f"kept_{docs.columns.index('text')}", pred="pred", score="score")
    keep = (F.col("pred") != languages.UNDECIDED) & (F.col("score") >= LEAST_SCORE)
    return found.where(keep).select(*(F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns)))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id; rows that share an id or have none are told apart by their texts."""
    return jaccard.first_rows(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too, with `n_chars` of what is left; those of which nothing is left go."""
    found = substrings.remove_repeats(docs)
    return found.where(F.length("text") > 0).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    found = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path(RANKS))
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("tokens", tokens),
]

#: SQL can express neither the fitted filters of the first stage nor BPE; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
