"""A training-data pipeline over ``documents``: quality, near-duplicates, benchmark passages, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, packing, quality, secrets, simhash
from corpusloom.llm.queries import table, tokenizer_path, with_library
from corpusloom.session import scratch_path

ORACLE_SQL = None
"""The classifier is fitted and the packing encodes with a tokenizer's file, which SQL cannot express."""


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled texts vote good."""
    with_library(spark)
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of three-word shingles that differ in two bits at most."""
    with_library(spark)
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    with_library(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of equal length."""
    with_library(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("simhash", keep_one_of_each),
    ("decontamination", drop_benchmark),
    ("secrets", redact),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage returns is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
