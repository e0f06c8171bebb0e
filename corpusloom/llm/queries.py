"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import (
    byte_bpe,
    decontamination,
    fill_in_middle,
    grammar_files,
    language,
    language_model,
    lexical,
    packing,
    quality,
    secrets,
    simhash,
    substrings,
    topk,
)
from corpusloom.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def with_library(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the library when it is not installed; clusters ship it by --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    with_library(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_grammar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "grammar")
    grammar_files.write_grammar_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return grammar_files.read_grammar_files(spark, path)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_windows(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target corpus is the texts labelled good, the background all texts.

    Both grow alike, so the join is a shuffle at every size, but of ids and not of texts.
    """
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    models = language_model.train_marked(docs, good)
    return language_model.cross_entropy_difference(docs, models)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_digest(table(spark, sf_dir, "documents"), byte_bpe.RankTable.load(tokenizer_path(RANKS)))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fim_digest(table(spark, sf_dir, "documents"))


QUERIES = {
    "op11_lexical": op11_lexical,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_fill_in_middle": op13_fill_in_middle,
    "op8_lm_scoring": op8_lm_scoring,
    "op4_decontamination": op4_decontamination,
    "op1_secrets": op1_secrets,
    "op5_topk": op5_topk,
    "op2_quality": op2_quality,
    "op3_language": op3_language,
    "op6_simhash": op6_simhash,
    "op9_substrings": op9_substrings,
    "op7_pack": op7_pack,
    "op10_grammar_files": op10_grammar_files,
}
