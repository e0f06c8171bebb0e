"""Writing and reading token shards."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.packing import TOKENS_PER_SLICE, TRAIN, VALID


def write_token_shards(shards: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One directory per ``(split, shard)``, its pieces in stream order in one file.

    Shards are dealt by range to tasks of about ``TOKENS_PER_SLICE`` tokens, which write one after another: a shuffle to
    as many tasks as there are shards would grow with the square of the input.
    """
    length = F.col("n_tokens") if "n_tokens" in shards.columns else F.size("tokens")
    last, tokens = shards.agg(F.max("shard"), F.sum(length.cast("bigint"))).first()
    wanted = max(shards.sparkSession.sparkContext.defaultParallelism, -(-(tokens or 0) // TOKENS_PER_SLICE))
    (
        shards.repartitionByRange(1 if last is None else min(last + 1, wanted), "shard")
        .sortWithinPartitions("split", "shard", "shard_pos")
        .write.mode(mode)
        .partitionBy("split", "shard")
        .parquet(path)
    )


def read_token_shards(spark: SparkSession, path: str, split: str) -> DataFrame:
    """The shards of one split; the other split is not read.  Fails if there is none."""
    if split not in (VALID, TRAIN):
        raise ValueError(f"unknown split {split!r}")
    try:
        shards = spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no token shards at {path}") from error
    chosen = shards.where(F.col("split") == split)
    if chosen.select("shard").limit(1).isEmpty():
        raise FileNotFoundError(f"no {split} shards at {path}: a corpus below one shard has no training split")
    return chosen


def shard_list(shards: DataFrame) -> DataFrame:
    """Distinct shards of a split in reading order."""
    return shards.select("split", "shard").distinct().orderBy("split", "shard")
