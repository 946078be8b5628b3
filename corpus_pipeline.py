"""The training-corpus pipeline: each stage is written as a table and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.llm import decontaminate, language, minhash, mixing, token_files
from ledgerlight.session import configure, cut


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose text is near enough to a language's centroids; lang is left as the table has it."""
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"), 5, 0)))
    return language.accepted(docs, model)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    found = minhash.near_duplicates(docs)
    kept = found.where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too large a share of words from benchmark items go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = decontaminate.contamination(docs, items).where("contaminated").select(F.col("doc_id").alias("bad_id"), "digest").distinct()
    # Written, so that its size is known before the join: texts are exchanged only where the list is too long to broadcast.
    bad = cut(bad, "contaminated")
    same = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["digest"])
    return docs.join(bad, same, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in document order; returns their index."""
    return token_files.tokenised(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", deduplicate),
    ("decontamination", remove_benchmarks),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]
ORACLE_SQL = None  # signatures, models and token ids are not SQL; tests/llm holds each stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
