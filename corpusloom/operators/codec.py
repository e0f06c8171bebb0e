"""Encoding and decoding of whole text columns.

A merge of id ``k`` only creates pairs that contain ``k``, and those merge to larger ids.  "Merge the present pair with
the lowest id until none is left" therefore visits the merges in increasing order, and one pass over the merge list in
rank order gives the same tokens.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.batched import merge_steps, merged_ids
from corpusloom.functions.folding import MergeMap, held_once
from corpusloom.functions.idstrings import GAP, MISSING, byte_string, fold_pairs, id_char, ids_of
from corpusloom.functions.literals import literals_in
from corpusloom.functions.packed import array_ids, packed_ids
from corpusloom.functions.patterns import GPT2PAT, GPT4PAT, followed, pretokenize
from corpusloom.functions.rendering import readable
from corpusloom.model import TokenizerModel
from corpusloom.session import stage_table

# Up to this many merges the pass over the whole document is cheaper than a dictionary of its pre-tokens.
FOLD_MERGES = 256
# Up to this many steps of merges whole texts are merged step by step, whatever the number of merges.
BATCHED_STEPS = 32
FEW_LITERALS = 8
# Split patterns whose matches leave nothing of a text out.
WHOLE_PATTERNS = {GPT2PAT, GPT4PAT}
# Bytes that texts hardly hold: one of them may stand between pre-tokens.
SEPARATORS = range(0x1F, 0x1B, -1)
# The part of the dictionary that is sent to every executor: at most so many rows and so many bytes of text.
HOT_ROWS = 500_000
HOT_BYTES = 64 << 20
# Up to this many merges a single pre-token tries them all; with more it looks up which its neighbours make.
WORD_FOLD_MERGES = 256
# Longer pieces look up which merges can apply to them at all, as a ranked fold takes time by the square of the length.
RANKED_LENGTH = 64
# Up to this many merges a longer piece tries them all.
LONG_FOLD_MERGES = 1_024
# Text in one task where the pieces of texts are put together: in memory they take about thirty times the room.
PLACED_BYTES = 16 << 20
# Kinds of bytes that tell words from what is between them: letters, digits, space, other white space, bytes of
# characters outside ASCII, and the rest.
_LETTERS = {value for value in range(128) if chr(value).isalpha()}
_DIGITS = set(range(48, 58))
_BLANKS = set(range(9, 14))
_HIGH = set(range(128, 256))
BYTE_KINDS = (
    _LETTERS,
    _DIGITS,
    {32},
    _BLANKS,
    _HIGH,
    set(range(256)) - _LETTERS - _DIGITS - {32} - _BLANKS - _HIGH,
)
# Reading a character of a string walks the string: substrings of longer pieces are read from windows of this size.
WINDOW = 64


def merge_string(seq: Column, model: TokenizerModel) -> Column:
    """All merges of the model, in rank order, over an id string."""
    return fold_pairs(seq, model.merge_triples())


def encode_text(text: Column, model: TokenizerModel) -> Column:
    """Ids of a whole text: merges may cross pre-token borders, the split pattern plays no part."""
    return ids_of(merge_string(byte_string(text), model), model.max_id)


def _merge_map(model: TokenizerModel) -> MergeMap:
    return MergeMap((id_char(left), id_char(right), id_char(token_id)) for left, right, token_id in model.merges)


def merged_pieces(text: Column, model: TokenizerModel, pattern: str | None = None) -> Column:
    """The id string of a text merged inside its pre-tokens, in place.

    With few merges each is tried on the whole text: the gap characters between the pre-tokens stop it (the gap is the id
    after the last one, which no text and no merge can produce).  Where nothing is left out and the text does not hold it,
    a separator of one byte is the gap, put behind each match in one pass that makes no array of them.  With many, each pre-token is folded by the merges that
    its neighbours make, so the cost follows the text and not the number of merges.  Without merges the pre-tokens that
    leave nothing out are the text itself, if that is valid UTF-8: what is not, a search replaces.
    """
    pattern = pattern or model.pattern or GPT4PAT
    matches = pretokenize(text, pattern)
    if not model.merges:
        joined = byte_string(F.array_join(matches, ""))
        return F.when(F.is_valid_utf8(text), byte_string(text)).otherwise(joined) if pattern in WHOLE_PATTERNS else joined
    if len(model.merges) > WORD_FOLD_MERGES:
        pieces = F.transform(matches, byte_string)

        def folded(fold: Callable[[Column], Column]) -> Column:
            def one(seq: Column) -> Column:
                return F.when(F.length(seq) <= RANKED_LENGTH, fold(seq)).otherwise(merge_string(seq, model))

            return F.array_join(F.transform(pieces, one), "")

        return _merge_map(model).folding(folded, "string")
    gap = id_char(model.max_id + 1)
    # Joined by a mark that the text does not hold, the pieces become bytes in one go.
    mark = byte_string(F.lit(GAP))
    marked = F.replace(byte_string(F.array_join(matches, GAP)), mark, F.lit(gap))
    pieces = F.when(F.contains(text, F.lit(GAP)), F.array_join(F.transform(matches, byte_string), gap)).otherwise(marked)
    stop = F.lit(gap)
    merging = {token_id for left, right, _ in model.merges for token_id in (left, right)}
    free = next((chr(byte) for byte in SEPARATORS if byte not in merging), None)
    if pattern in WHOLE_PATTERNS and free:
        held = F.contains(text, F.lit(free))
        pieces = F.when(held, pieces).otherwise(byte_string(followed(text, pattern, free)))
        stop = F.when(held, stop).otherwise(F.lit(free))
    return F.replace(merge_string(pieces, model), stop, F.lit(""))


def encode_pieces(text: Column, model: TokenizerModel, pattern: str | None = None) -> Column:
    """Ids of a text encoded inside its pre-tokens (see :func:`merged_pieces`), by built-in functions alone."""
    return ids_of(merged_pieces(text, model, pattern), model.max_id)


def encode_corpus(
    df: DataFrame,
    model: TokenizerModel,
    mode: str = "pretoken",
    strategy: str = "auto",
    pattern: str | None = None,
    text_col: str = "text",
    out: str = "tokens",
    lead: int | None = None,
    packed: bool = False,
) -> DataFrame:
    """Add the token ids of ``text_col`` as ``ARRAY<INT>``, or as packed bytes (``functions.packed``), the id ``lead`` before them.

    ``mode="text"`` merges over the whole text, ``mode="pretoken"`` inside each match of the split pattern.
    ``strategy="fold"`` works in place without a shuffle at a cost of merges x text; ``"dictionary"`` encodes each
    frequent piece of the texts once and looks it up, and rare ones in place; it stages ``df`` and runs when called.
    ``"steps"``, for whole texts, makes all merges of a step at once (``functions.batched``): it works in place at a cost of
    steps x text.  ``"auto"``, when there are many merges, takes the steps for whole texts if they are few, else the
    dictionary.  All give the same ids: null for a null text, whatever the ids of the rows.
    """
    if mode not in ("text", "pretoken"):
        raise ValueError(f"unknown mode {mode!r}")
    if strategy == "auto":
        strategy = "dictionary" if len(model.merges) > FOLD_MERGES else "fold"
        if strategy == "dictionary" and mode == "text" and len(merge_steps(model.merges)) <= BATCHED_STEPS:
            strategy = "steps"
    text = F.col(text_col)
    if strategy == "steps":
        if mode != "text":
            raise ValueError("steps merge over whole texts")
        return df.withColumn(out, merged_ids(text, model.merges, lead, packed))

    def ids(seq: Column) -> Column:
        whole = seq if lead is None else F.concat(F.lit(id_char(lead)), seq)
        return packed_ids(whole) if packed else array_ids(whole)

    if strategy == "fold":
        seq = merge_string(byte_string(text), model) if mode == "text" else merged_pieces(text, model, pattern)
        # The generator keeps the optimizer from copying the encoding into other uses of the ids.
        return df.select("*", F.explode(F.array(seq)).alias("_seq")).withColumn(out, ids(F.col("_seq"))).drop("_seq")
    if strategy != "dictionary":
        raise ValueError(f"unknown strategy {strategy!r}")
    if mode == "text":
        pieces, to_seq = free_segments(text, model), _as_is
    else:
        pieces, to_seq = pretokenize(text, pattern or model.pattern or GPT4PAT), byte_string
    return _encode_by_dictionary(df, model, pieces, to_seq, text_col, out, ids)


def _as_is(seq: Column) -> Column:
    return seq


def _byte_class(values: Iterable[int]) -> str:
    return "[" + "".join(f"\\x{{{value:02x}}}" for value in sorted(values)) + "]"


def free_segments(text: Column, model: TokenizerModel) -> Column:
    """The bytes of a text as an array of id strings between which no merge of the model can happen.

    Two neighbouring bytes can only end up in one token if some token holds them side by side.  Bytes are taken in a few
    kinds, and a text is cut after a byte where no byte of its kind goes on to the next byte inside any token; the
    kinds only make the cuts fewer, never wrong.
    """
    follows: dict[int, set[int]] = {}
    for token in model.vocab().values():
        for first, second in zip(token, token[1:]):
            follows.setdefault(first, set()).add(second)
    cuts = []
    for kind in BYTE_KINDS:
        stopped = set(range(256)).difference(*(follows.get(value, ()) for value in kind))
        if stopped:
            cuts.append(f"(?<={_byte_class(kind)})(?={_byte_class(stopped)})")
    seq = byte_string(text)
    return F.split(seq, "|".join(cuts)) if cuts else F.array(seq)


def _present_merges(seq: Column, model: TokenizerModel) -> Column:
    """An id string after its merges, for long strings and long lists of merges.

    Only merges whose bytes occur in a string can apply to it, so its substrings are looked up among the tokens and only
    the hits are tried, in rank order.  Nothing is shuffled.
    """
    vocab = model.vocab()
    longest = max(len(vocab[token_id]) for _, _, token_id in model.merges)
    # Several merges can produce the same bytes.  A hit begins with the merged character, so hits sort by rank.
    mask = (1 << len(model.merges).bit_length()) - 1
    buckets: list[dict[str, list[str]]] = [{} for _ in range(mask + 1)]
    for left, right, token_id in model.merges:
        token = vocab[token_id].decode("latin-1")
        hit = id_char(token_id) + id_char(left) + id_char(right)
        buckets[zlib.crc32(token.encode()) & mask].setdefault(token, []).append(hit)
    known = F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<map<string,array<string>>>")
    none = F.array().cast("array<string>")
    # Each window goes on far enough for every token that begins in its first WINDOW characters.
    span = WINDOW + longest - 1
    windows = F.when(F.length(seq) <= span, F.array(seq)).otherwise(
        F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{1,{span}}})).{{1,{WINDOW}}}"), F.lit(1))
    )

    def substrings(window: Column) -> Column:
        starts = F.sequence(F.lit(1), F.least(F.length(window) - 1, F.lit(span)))

        def at(i: Column) -> Column:
            sizes = F.sequence(F.lit(2), F.least(F.lit(longest), F.length(window) - i + 1))
            return F.transform(sizes, lambda n: F.substring(window, i, n))

        return F.when(F.length(window) > 1, F.flatten(F.transform(starts, at))).otherwise(none)

    def hits(held: Column) -> Column:
        def look(token: Column) -> Column:
            place = F.crc32(token.cast("binary")).bitwiseAND(F.lit(mask).cast("bigint")).cast("int")
            return F.coalesce(F.get(held, place)[token], none)

        distinct = F.array_distinct(F.flatten(F.transform(windows, substrings)))
        return F.sort_array(F.flatten(F.transform(distinct, look)))

    found = held_once(known, hits, "array<string>")
    return F.aggregate(found, seq, lambda acc, m: F.replace(acc, F.substring(m, 2, 2), F.substring(m, 1, 1)))


def merge_word(seq: Column, model: TokenizerModel) -> Column:
    """All merges of the model over the id string of one piece, in place.

    With many merges a piece is folded by those that its neighbours make, looked up in a constant map: neither the number
    of merges nor the longest token plays a part.  Pieces above ``RANKED_LENGTH`` try all merges, or those present.
    """
    if len(model.merges) <= WORD_FOLD_MERGES:
        return merge_string(seq, model)
    long = merge_string(seq, model) if len(model.merges) <= LONG_FOLD_MERGES else _present_merges(seq, model)
    folded = _merge_map(model).folding(lambda fold: fold(seq), "string")
    return F.when(F.length(seq) <= RANKED_LENGTH, folded).otherwise(long)


def encode_words(
    words: DataFrame,
    model: TokenizerModel,
    word_col: str = "piece",
    out: str = "merged",
    to_seq: Callable[[Column], Column] = byte_string,
) -> DataFrame:
    """Add the merged id string of each (distinct) ``word_col``; ``to_seq`` turns a word into its bytes."""
    return words.withColumn(out, merge_word(to_seq(F.col(word_col)), model))


def _hot_threshold(words: DataFrame) -> int:
    """Smallest power of two such that the pieces used at least so often fit the bounds of the broadcast table.

    Counts are grouped by their binary length, so at most 63 rows reach the driver.  A merged string takes at most twice
    the bytes of its piece.
    """
    levels = (
        words.groupBy(F.length(F.bin("n")).alias("bits"))
        .agg(F.count(F.lit(1)).alias("rows"), (F.sum(F.octet_length("piece")) * 3).alias("size"))
        .orderBy(F.desc("bits"))
        .collect()
    )
    threshold, rows, size = 1 << 62, 0, 0
    for level in levels:
        rows, size = rows + level["rows"], size + level["size"]
        if rows > HOT_ROWS or size > HOT_BYTES:
            return threshold
        threshold = 1 << (level["bits"] - 1)
    return 1


def _encode_by_dictionary(
    df: DataFrame,
    model: TokenizerModel,
    pieces: Column,
    to_seq: Callable[[Column], Column],
    text_col: str,
    out: str,
    ids: Callable[[Column], Column],
) -> DataFrame:
    """Encode each frequent piece once and look its occurrences up; rare ones are encoded where they stand.

    The rows are staged under a number of their own, so null or repeated ids do not matter.  The texts are dealt by it
    while they are compact, to partitions of ``PLACED_BYTES``: their pieces are put together again without a shuffle and
    in memory.  Frequent pieces are looked up in a broadcast table of bounded size.
    """
    rows = stage_table(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    words = stage_table(
        rows.select(F.explode(pieces).alias("piece"))
        .where(F.col("piece") != "")
        .groupBy("piece")
        .agg(F.count(F.lit(1)).alias("n")),
        "words",
    )
    frequent = words.where(F.col("n") >= _hot_threshold(words)).select("piece")
    hot = stage_table(encode_words(frequent, model, to_seq=to_seq), "dictionary")

    size = rows.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0
    dealt = rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // PLACED_BYTES)), "_row")
    occurrences = dealt.select("_row", F.posexplode(pieces).alias("idx", "piece")).where(F.col("piece") != "")
    in_place = merge_word(to_seq(F.col("piece")), model)
    merged = (
        occurrences.join(F.broadcast(hot), "piece", "left")
        .select("_row", F.struct("idx", F.coalesce("merged", in_place).alias("merged")).alias("_part"))
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
        .select("_row", F.array_join(F.transform("_parts", lambda p: p["merged"]), "").alias("_merged"))
    )
    # A text without pieces has no occurrence and still keeps its row; a null text stays null.
    whole = F.when(F.col(text_col).isNotNull(), F.coalesce("_merged", F.lit("")))
    return dealt.join(merged, "_row", "left").withColumn(out, ids(whole)).drop("_row", "_merged")


def decode_tokens(tokens: Column, model: TokenizerModel, render_special: bool = False) -> Column:
    """Text of an id array; invalid bytes become U+FFFD, an unknown id raises."""
    vocab = model.vocab_strings(render_special)

    def token_bytes(token_id: Column) -> Column:
        found = F.get(vocab, token_id)
        unknown = F.raise_error(F.concat(F.lit("unknown token id "), token_id.cast("string"))).cast("string")
        return F.when(found.isNull() | (found == MISSING), unknown).otherwise(found)

    joined = F.array_join(F.transform(tokens, token_bytes), "")
    return readable(F.encode(joined, "ISO-8859-1"))


def decode_corpus(
    df: DataFrame,
    model: TokenizerModel,
    render_special: bool = False,
    tokens_col: str = "tokens",
    out: str = "decoded",
) -> DataFrame:
    """Add the text of a token column, row by row in place: the vocabulary is a constant array indexed by id."""
    return df.withColumn(out, decode_tokens(F.col(tokens_col), model, render_special))


def round_trip_report(
    df: DataFrame,
    model: TokenizerModel,
    mode: str = "pretoken",
    group_col: str = "lang",
    text_col: str = "text",
    **encode_options,
) -> DataFrame:
    """Per group: documents, exact round trips, bytes, tokens and tokens per byte."""
    encoded = encode_corpus(df, model, mode, text_col=text_col, **encode_options)
    decoded = decode_corpus(encoded, model)
    same = (F.col("decoded") == F.col(text_col)).cast("bigint")
    return (
        decoded.groupBy(group_col)
        .agg(
            F.count(F.lit(1)).alias("docs"),
            F.sum(same).alias("exact"),
            F.sum(F.octet_length(text_col)).alias("bytes"),
            F.sum(F.size("tokens")).alias("tokens"),
        )
        .withColumn("tokens_per_byte", F.col("tokens") / F.col("bytes"))
    )


def special_tokens_in(text: Column, model: TokenizerModel) -> Column:
    """The special-token literals a text holds, as an array: a few are looked for one by one, many in one pass."""
    if len(model.special_tokens) > FEW_LITERALS:
        return literals_in(text, list(model.special_tokens))
    literals = [F.when(F.contains(text, F.lit(token)), F.lit(token)) for token in model.special_tokens]
    return F.array_compact(F.array(*literals)) if literals else F.array().cast("array<string>")


def special_token_audit(df: DataFrame, model: TokenizerModel, text_col: str = "text") -> DataFrame:
    """Documents that hold a special-token literal, per token: a strict encoder refuses them."""
    return (
        df.select(F.explode(special_tokens_in(F.col(text_col), model)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("docs"))
    )


def reject_special_tokens(text: Column, model: TokenizerModel) -> Column:
    """``text`` itself, or an error if it holds a special-token literal (the strict encoder's rule)."""
    found = special_tokens_in(text, model)
    refused = F.raise_error(F.concat(F.lit("special token in text: "), F.get(found, F.lit(0)))).cast("string")
    return F.when(F.size(found) > 0, refused).otherwise(text)
