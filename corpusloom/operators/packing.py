"""Documents to token shards: one stream in document order, cut into shards of equal size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from corpusloom.functions.packed import packed_size, packed_slice, unpacked_ids
from corpusloom.model import ID_BOUND, MAX_ID, TokenizerModel
from corpusloom.operators.codec import encode_corpus
from corpusloom.operators.pretokens import present
from corpusloom.plans.offsets import div, running_offset

END_OF_TEXT = "<|endoftext|>"
VALID, TRAIN = "valid", "train"
# Tokens that are sorted and numbered in one go: 16 MB.
TOKENS_PER_SLICE = 4_000_000


def tokenize_documents(
    df: DataFrame,
    model: TokenizerModel,
    eot_id: int | None = None,
    text_col: str = "text",
    id_col: str = "doc_id",
    packed: bool = False,
    **encode_options,
) -> DataFrame:
    """``(id_col, n_tokens, tokens)``: the separator comes before each document.  A null text raises.

    ``packed`` gives the tokens as bytes, four each, which packing and batches take as well: they are staged, shuffled
    and cut without a look at the single token.

    Stage the result (:func:`corpusloom.session.stage_table`) before packing it: the stream positions then come from
    ``n_tokens`` alone, and no text is encoded twice.
    """
    if eot_id is None:
        eot_id = model.special_tokens[END_OF_TEXT]
    kept = df.withColumn(text_col, present(F.col(text_col)))
    # A separator that no character stands for is put before the ids.
    lead = eot_id if packed or 0 <= eot_id < MAX_ID else None
    marked = encode_corpus(kept, model, text_col=text_col, lead=lead, packed=packed, **encode_options)
    if lead is None:
        marked = marked.withColumn("tokens", F.concat(F.array(F.lit(eot_id)), "tokens"))
    return marked.select(id_col, size_of_tokens(marked).cast("bigint").alias("n_tokens"), "tokens")


def has_packed_tokens(df: DataFrame) -> bool:
    return isinstance(df.schema["tokens"].dataType, BinaryType)


def size_of_tokens(df: DataFrame) -> Column:
    """Tokens of a row, packed or not."""
    return packed_size(F.col("tokens")) if has_packed_tokens(df) else F.size("tokens")


def slice_of_tokens(df: DataFrame, start: Column, length: Column) -> Column:
    """``length`` tokens of a row from the place ``start``, which counts from 0, in the form they have."""
    tokens = F.col("tokens")
    return packed_slice(tokens, start, length) if has_packed_tokens(df) else F.slice(tokens, (start + 1).cast("int"), length)


def unpacked_tokens(df: DataFrame) -> DataFrame:
    """The frame with its packed tokens as ``ARRAY<INT>``."""
    return df.withColumn("tokens", unpacked_ids(F.col("tokens")))


def _out_of_bounds(bound: int):
    return lambda token_id: token_id.isNull() | (token_id < 0) | (token_id >= bound)


def invalid_token_ids(df: DataFrame, bound: int = ID_BOUND, id_col: str = "doc_id") -> DataFrame:
    """Documents with null ids or ids outside ``[0, bound)``, and those ids."""
    bad = F.filter("tokens", _out_of_bounds(bound))
    # The generator keeps the optimizer from moving the filter, and with it the encoding of the ids, below a shuffle.
    return df.select(id_col, F.explode(F.array(bad)).alias("bad_ids")).where(F.size("bad_ids") > 0)


def validate_token_ids(df: DataFrame, bound: int = ID_BOUND) -> DataFrame:
    """The same frame; reading a row with a null id or one outside ``[0, bound)`` raises."""
    bad = F.raise_error(F.lit(f"token id outside [0, {bound})")).cast("array<int>")
    checked = F.when(F.exists("tokens", _out_of_bounds(bound)), bad).otherwise(F.col("tokens"))
    return df.withColumn("tokens", checked)


def token_offsets(df: DataFrame, order_col: str = "doc_id", slices: int | None = None) -> DataFrame:
    """``(order_col, n_tokens, offset)``: where each document starts in the stream.

    Only ids and lengths take part; a staged frame with an ``n_tokens`` column is not read any further.
    """
    length = F.col("n_tokens") if "n_tokens" in df.columns else size_of_tokens(df)
    lengths = df.select(order_col, length.cast("bigint").alias("n_tokens"))
    return running_offset(lengths, order_col, F.col("n_tokens"), slices=slices)


def assign_split(shard: Column) -> Column:
    """The first shard is for validation, all others for training."""
    return F.when(shard == 0, F.lit(VALID)).otherwise(F.lit(TRAIN))


def pack_shards(
    df: DataFrame, shard_size: int, order_col: str = "doc_id", slices: int | None = None
) -> DataFrame:
    """``(split, shard, shard_pos, order_col, n_tokens, tokens)``: the stream cut at every multiple of ``shard_size``.

    ``order_col`` is the order of the stream; a null or repeated value raises.  The tokens, packed or not, are shuffled once, with their
    slice of the order, which holds about ``TOKENS_PER_SLICE`` of them.  A document at a border is split, one longer than a shard is split several times; the last
    shard is shorter.
    """
    size = F.lit(shard_size).cast("bigint")
    length = F.col("n_tokens") if "n_tokens" in df.columns else size_of_tokens(df)
    lengths = df.select(order_col, length.cast("bigint").alias("n_tokens"), "tokens")
    size_of = F.coalesce("n_tokens", F.lit(1))
    placed = running_offset(lengths, order_col, F.col("n_tokens"), slices=slices, weight=size_of, per_slice=TOKENS_PER_SLICE)
    begin, end = F.col("offset"), F.col("offset") + F.col("n_tokens")
    pieces = placed.where(F.col("n_tokens") > 0).select(
        order_col,
        "tokens",
        begin.alias("begin"),
        end.alias("end"),
        F.explode(F.sequence(div(begin, size), div(end - 1, size))).alias("shard"),
    )
    left = F.greatest(F.col("shard") * size, F.col("begin"))
    right = F.least((F.col("shard") + 1) * size, F.col("end"))
    # Never below 0, also for rows that a pushed-down filter on the shard looks at before it drops them.
    taken = F.greatest(right - left, F.lit(0)).cast("int")
    return pieces.select(
        assign_split(F.col("shard")).alias("split"),
        F.col("shard").cast("int").alias("shard"),
        (left - F.col("shard") * size).alias("shard_pos"),
        order_col,
        taken.cast("bigint").alias("n_tokens"),
        slice_of_tokens(df, left - F.col("begin"), taken).alias("tokens"),
    )


def shard_name(prefix: str) -> Column:
    """Logical name of a shard: ``prefix_split_000000``."""
    return F.format_string(f"{prefix}_%s_%06d", F.col("split"), F.col("shard"))


def shard_manifest(shards: DataFrame, prefix: str = "corpus") -> DataFrame:
    """Per shard: name, token count and documents touched (a document has one piece in a shard); reads no tokens."""
    return (
        shards.groupBy("split", "shard")
        .agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"))
        .select("split", "shard", shard_name(prefix).alias("name"), "n_tokens", "n_docs")
    )


def plan_shards(manifest: DataFrame, total_size: int | None, shard_size: int) -> DataFrame:
    """Planned number of full shards (``total_size // shard_size``) against the shards and tokens found."""
    found = manifest.agg(F.count(F.lit(1)).alias("found"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"))
    total = F.col("tokens") if total_size is None else F.lit(total_size).cast("bigint")
    return found.select(div(total.cast("bigint"), F.lit(shard_size).cast("bigint")).alias("planned"), "found", "tokens")
