"""Byte sequences and pre-tokens of a text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.idstrings import byte_string, ids_of
from corpusloom.functions.patterns import GPT4PAT, pretokenize
from corpusloom.plans.offsets import running_offset

# Order ids below this leave room for any position in a text, as a text has fewer than 2^31 bytes.
ROOMY_ORDER = 1 << 31


def byte_tokens(text: Column) -> Column:
    """UTF-8 bytes of a text as ids 0..255."""
    return ids_of(byte_string(text), max_id=255)


def order_stride(df: DataFrame, order_col: str) -> int:
    """Largest power of two that may multiply ``order_col`` without leaving BIGINT (reads that one column)."""
    low, high = df.agg(F.min(order_col), F.max(order_col)).first()
    if low is not None and low < 0:
        raise ValueError(f"{order_col} must not be negative")
    return 1 << (62 - max(1, int(high or 0).bit_length()))


def ordered_key(order: Column, position: Column, stride: int) -> Column:
    """One BIGINT that sorts like ``(order, position)``; positions that do not fit raise instead of colliding."""
    key = order.cast("bigint") * F.lit(stride) + position
    return F.when(position < stride, key).otherwise(
        F.raise_error(F.lit("a document is too long for its order key: use smaller, dense order ids")).cast("bigint")
    )


def dense_order(df: DataFrame, order_col: str = "doc_id") -> DataFrame:
    """``df`` with ``order_col`` replaced by its rank where its values are negative or too far apart for a key, as hashes
    are; else ``df`` as it is.

    The ranks come from the distinct values alone, by slices of the order; the texts are then joined once by that
    column.  Rows with one value keep one rank, so results that depend on the order stay the same.  A null order raises.
    """
    low, high = df.agg(F.min(order_col), F.max(order_col)).first()
    if low is None or (low >= 0 and high < ROOMY_ORDER):
        return df
    values = df.select(F.col(order_col).cast("bigint").alias("_value")).distinct()
    ranks = running_offset(values, "_value", F.lit(1), out="_rank")
    joined = df.join(ranks, df[order_col].eqNullSafe(F.col("_value")))
    return joined.select(*(F.col("_rank").alias(c) if c == order_col else F.col(c) for c in df.columns))


def present(text: Column) -> Column:
    """The text itself; null raises."""
    return F.coalesce(text, F.raise_error(F.lit("null text")).cast("string"))


def split_pretokens(
    df: DataFrame, pattern: str = GPT4PAT, text_col: str = "text", order_col: str = "doc_id"
) -> DataFrame:
    """One row per pre-token: ``(order_col, split_idx, pretoken)``; a null text raises."""
    return df.select(order_col, F.posexplode(pretokenize(present(F.col(text_col)), pattern)).alias("split_idx", "pretoken"))


def pretoken_counts(
    df: DataFrame, pattern: str = GPT4PAT, text_col: str = "text", order_col: str = "doc_id"
) -> DataFrame:
    """Distinct pre-tokens with their number of uses and the key of their first use.

    Counting combines on the map side, so a pre-token that makes up much of the corpus is one row per task.
    """
    stride = order_stride(df, order_col)
    return (
        split_pretokens(df, pattern, text_col, order_col)
        .where(F.col("pretoken") != "")
        .select("pretoken", ordered_key(F.col(order_col), F.col("split_idx"), stride).alias("first_key"))
        .groupBy("pretoken")
        .agg(F.count(F.lit(1)).alias("n"), F.min("first_key").alias("first_key"))
    )
