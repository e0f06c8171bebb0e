"""A trained tokenizer: a few small tables.

The merge list and the bytes of its tokens are bounded (``MAX_ID``, ``MAX_VOCAB_BYTES``), so the driver holds them; everything that touches
a corpus is a DataFrame expression over constants taken from it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.idstrings import MISSING, string_array, triple
from corpusloom.functions.rendering import readable, render_token

FIRST_MERGE_ID = 256
ID_BOUND = 1 << 16
# Bounds of what the driver holds and sends to tasks: ids, and bytes of all tokens together.
MAX_ID = 1_000_000
MAX_VOCAB_BYTES = 256 << 20
VERSION = "v1"

MERGES_SCHEMA = T.StructType(
    [
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("left", T.IntegerType(), False),
        T.StructField("right", T.IntegerType(), False),
        T.StructField("token_id", T.IntegerType(), False),
    ]
)
VOCAB_SCHEMA = T.StructType(
    [T.StructField("token_id", T.IntegerType(), False), T.StructField("bytes", T.BinaryType(), False)]
)
SPECIALS_SCHEMA = T.StructType(
    [T.StructField("token", T.StringType(), False), T.StructField("token_id", T.IntegerType(), False)]
)
META_SCHEMA = T.StructType(
    [
        T.StructField("version", T.StringType(), False),
        T.StructField("pattern", T.StringType(), True),
        T.StructField("base_vocab", T.IntegerType(), False),
    ]
)
TRACE_SCHEMA = T.StructType(
    [
        T.StructField("round", T.IntegerType(), False),
        T.StructField("left", T.IntegerType(), False),
        T.StructField("right", T.IntegerType(), False),
        T.StructField("token_id", T.IntegerType(), False),
        T.StructField("cnt", T.LongType(), False),
    ]
)


def checked_merges(merges: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The merges, if their ids rise and each is made of smaller ids and of a pair of its own.

    Only then is one pass in this order the same as "merge the present pair of lowest id until none is left".
    """
    pairs, last = set(), FIRST_MERGE_ID - 1
    for left, right, token_id in merges:
        if token_id <= last:
            raise ValueError(f"merge ids must rise from {FIRST_MERGE_ID}: {token_id} follows {last}")
        if not (0 <= left < token_id and 0 <= right < token_id) or (left, right) in pairs:
            raise ValueError(f"merge {token_id} repeats a pair or has parts that are not smaller ids: {left}, {right}")
        pairs.add((left, right))
        last = token_id
    if last >= MAX_ID:
        raise ValueError(f"token ids must be below {MAX_ID}")
    return merges


class TokenizerModel:
    """Merges in rank order, the split pattern they were trained with (``None``: whole texts), special tokens."""

    def __init__(
        self,
        merges: Iterable[tuple[int, int, int]] | None = None,
        pattern: str | None = None,
        special_tokens: Mapping[str, int] | None = None,
        trace: Iterable | None = None,
    ) -> None:
        self._merges = None if merges is None else checked_merges([tuple(map(int, merge)) for merge in merges])
        self.pattern = pattern
        self.special_tokens: dict[str, int] = {}
        self.trace = list(trace or [])
        if special_tokens:
            self.add_special_tokens(special_tokens)

    @property
    def merges(self) -> list[tuple[int, int, int]]:
        """``(left, right, token_id)`` in rank order; raises if the model has not been trained or loaded."""
        if self._merges is None:
            raise ValueError("the tokenizer has not been trained yet")
        return self._merges

    def add_special_tokens(self, tokens: Mapping[str, int]) -> None:
        """Add or overwrite special tokens; two tokens may not share an id."""
        updated = {**self.special_tokens, **{token: int(token_id) for token, token_id in tokens.items()}}
        if len(set(updated.values())) != len(updated):
            raise ValueError("two special tokens share an id")
        self.special_tokens = updated

    @property
    def special_ids(self) -> dict[int, str]:
        return {token_id: token for token, token_id in self.special_tokens.items()}

    def vocab(self) -> dict[int, bytes]:
        """Bytes of every id: the 256 single bytes, then each merge as the bytes of its two parts."""
        table = {i: bytes([i]) for i in range(FIRST_MERGE_ID)}
        size = FIRST_MERGE_ID
        for left, right, token_id in self.merges:
            if left not in table or right not in table:
                raise ValueError(f"merge {token_id} has a part that no merge makes")
            size += len(table[left]) + len(table[right])
            if size > MAX_VOCAB_BYTES:
                raise ValueError(f"the tokens take more than {MAX_VOCAB_BYTES} bytes together")
            table[token_id] = table[left] + table[right]
        return table

    @property
    def vocab_size(self) -> int:
        return len({token_id for _, _, token_id in self.merges}) + FIRST_MERGE_ID

    @property
    def max_id(self) -> int:
        """Largest id that encoding can produce."""
        return max((token_id for _, _, token_id in self.merges), default=FIRST_MERGE_ID - 1)

    # Constant columns

    def merge_triples(self) -> Column:
        """The merges as a constant array of three-character strings."""
        return string_array(triple(*merge) for merge in self.merges)

    def vocab_strings(self, render_special: bool = False) -> Column:
        """Constant array that holds, at index ``id``, the bytes of the id as an ISO-8859-1 string."""
        table = self.vocab()
        if render_special:
            table |= {token_id: token.encode() for token, token_id in self.special_tokens.items()}
        return string_array(
            table[i].decode("latin-1") if i in table else MISSING for i in range(max(table) + 1)
        )

    # Tables

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [(rank, *merge) for rank, merge in enumerate(self.merges)]
        return spark.createDataFrame(rows, MERGES_SCHEMA)

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, bytearray(b)) for i, b in self.vocab().items()], VOCAB_SCHEMA)

    def specials_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.special_tokens.items()), SPECIALS_SCHEMA)

    def meta_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(VERSION, self.pattern, FIRST_MERGE_ID)], META_SCHEMA)

    def trace_table(self, spark: SparkSession) -> DataFrame:
        """The training record: round, pair, new id, count of the pair."""
        rows = [(r.round, r.left, r.right, r.token_id, r.cnt) for r in self.trace]
        return spark.createDataFrame(rows, TRACE_SCHEMA)


def _with_parts(merges: DataFrame, vocab: DataFrame) -> DataFrame:
    """Merges with the bytes of both parts and of the result (all three tables are bounded by the id range)."""

    def named(prefix: str) -> DataFrame:
        return vocab.select(F.col("token_id").alias(f"{prefix}_id"), F.col("bytes").alias(f"{prefix}_bytes"))

    return (
        merges.join(named("left"), F.col("left") == F.col("left_id"))
        .join(named("right"), F.col("right") == F.col("right_id"))
        .join(named("merged"), F.col("token_id") == F.col("merged_id"))
        .select("rank", "token_id", "left_bytes", "right_bytes", "merged_bytes")
    )


def merges_pretty(spark: SparkSession, model: TokenizerModel) -> DataFrame:
    """``[a][b] -> [ab]`` for every merge, in rank order."""
    parts = _with_parts(model.merges_table(spark), model.vocab_table(spark))
    line = F.format_string(
        "[%s][%s] -> [%s]",
        readable(F.col("left_bytes")),
        readable(F.col("right_bytes")),
        readable(F.col("merged_bytes")),
    )
    return parts.select("rank", line.alias("merge")).orderBy("rank")


def vocab_report(spark: SparkSession, model: TokenizerModel) -> DataFrame:
    """``[s0][s1] -> [s] id`` for merged tokens and ``[s] id`` for single bytes, control characters escaped."""
    vocab = model.vocab_table(spark)
    parts = _with_parts(model.merges_table(spark), vocab).select("token_id", "left_bytes", "right_bytes")
    own, left, right = (render_token(F.col(name)) for name in ("bytes", "left_bytes", "right_bytes"))
    line = F.when(
        F.col("left_bytes").isNotNull(), F.format_string("[%s][%s] -> [%s] %d", left, right, own, F.col("token_id"))
    ).otherwise(F.format_string("[%s] %d", own, F.col("token_id")))
    return vocab.join(parts, "token_id", "left").select("token_id", line.alias("line")).orderBy("token_id")


def upsert_special_tokens(current: DataFrame, added: DataFrame) -> DataFrame:
    """The table form of :meth:`TokenizerModel.add_special_tokens`: new rows replace rows of the same token."""
    merged = current.join(added, "token", "left_anti").unionByName(added)
    shared = F.count(F.lit(1)).over(Window.partitionBy("token_id")) > 1
    return merged.select(
        "token",
        F.when(shared, F.raise_error(F.lit("two special tokens share an id")).cast("int"))
        .otherwise(F.col("token_id"))
        .alias("token_id"),
    )
