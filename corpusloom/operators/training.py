"""Building a byte-level BPE vocabulary from a corpus.

The state is a frame of weighted sequences ``(seq, n, start)``: an id string, how often it occurs, and the position of
its first token in the (deduplicated) corpus stream.  ``start`` keeps ties exact: of two equally frequent pairs the one
seen first in corpus order wins.

A pass over the frame yields the leading pairs.  Merging one pair only touches pairs that share a token with it at the
joint, so a leading run of pairs of which none ends with the token another begins with keeps its counts and its order:
the whole run is taken from one pass.  Pairs created by those merges cannot overtake the run, as each of their
occurrences stands on an occurrence of an old pair that ranks behind it.

Counts of words are kept: a sequence that merges change remembers what it was, and only such sequences give up their old pairs
and add their new ones.  Texts nearly all change, so their pairs are counted anew, with positions.  Positions are not kept, as the first place of a pair can move back; they are looked up
in a whole pass where they decide, that is where the leading counts are equal.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from corpusloom.functions.batched import counted_pairs
from corpusloom.functions.idstrings import GAP, byte_string, char_id, id_char
from corpusloom.model import FIRST_MERGE_ID, MAX_ID, TokenizerModel
from corpusloom.operators.pretokens import dense_order, order_stride, ordered_key, present, pretoken_counts
from corpusloom.plans.offsets import running_offset
from corpusloom.session import materialize

# Pairs looked at per pass (rows sent to the driver), merges between two rewrites of the frame, and
# sequences per partition of the frame.
LEADING_PAIRS = 256
MERGES_PER_REWRITE = 32
MERGES_PER_CODE = 8
SEQUENCES_PER_PARTITION = 500_000

# Reading a character of a string walks the string, so where a sequence is longer than LONG all are split into tokens
# before pairs are read off, pieces of PIECE tokens at a time.
LONG = 512
PIECE = 4_096
# Sequences of more tokens on the average are texts, which nearly every merge changes: their pairs are counted anew.
TEXT_LENGTH = 256


def byte_sequences(df: DataFrame, text_col: str = "text", order_col: str = "doc_id") -> DataFrame:
    """Every text as one weighted sequence of bytes; a null text raises."""
    df = df.withColumn(text_col, present(F.col(text_col)))
    stride = order_stride(df, order_col)
    size = F.octet_length(F.col(text_col))
    return df.select(
        byte_string(F.col(text_col)).alias("seq"),
        F.lit(1).cast("bigint").alias("n"),
        # The last position is checked as well: the key of the first one leaves room for the whole text.
        (ordered_key(F.col(order_col), size, stride) - size).alias("start"),
    )


def pretoken_sequences(df: DataFrame, pattern: str, text_col: str = "text", order_col: str = "doc_id") -> DataFrame:
    """Every distinct pre-token as one weighted sequence of bytes, placed in order of first use."""
    words = materialize(pretoken_counts(df, pattern, text_col, order_col))
    placed = running_offset(words, "first_key", F.octet_length("pretoken"), out="start")
    return placed.select(byte_string(F.col("pretoken")).alias("seq"), "n", "start")


def _adjacent(pieces: DataFrame) -> DataFrame:
    """``(pair, n, at)`` of short sequences ``(seq, n, start)``, inside one compiled stage."""
    return (
        pieces.where(F.length("seq") > 1)
        .select("seq", "n", "start", F.explode(F.sequence(F.lit(1), F.length("seq") - 1)).alias("i"))
        .select(
            F.substring(F.col("seq"), F.col("i"), F.lit(2)).alias("pair"),
            "n",
            (F.col("start") + F.col("i") - 1).alias("at"),
        )
    )


def _pair_rows(sequences: DataFrame, any_long: bool = True) -> DataFrame:
    """One row per adjacent pair: ``(pair, n, at)`` with ``pair`` as a two-character id string."""
    if not any_long:
        return _adjacent(sequences)
    # Each piece reads one token further than it advances, so that no pair is lost at a cut.  One scan for long and
    # short sequences alike: a union would double the plan with every cached frame below it.
    pieces = F.when(F.length("seq") <= PIECE, F.array("seq")).otherwise(
        F.regexp_extract_all("seq", F.lit(f"(?s)(?=(.{{1,{PIECE + 1}}})).{{1,{PIECE}}}"), F.lit(1))
    )
    left, right = F.get("tokens", F.col("i")), F.get("tokens", F.col("i") + 1)
    return (
        sequences.where(F.length("seq") > 1)
        .select("n", "start", F.posexplode(pieces).alias("piece_no", "seq"))
        .where(F.length("seq") > 1)
        .select("n", (F.col("start") + F.col("piece_no") * PIECE).alias("start"), F.explode(F.array(F.split("seq", ""))).alias("tokens"))
        .select("n", "start", "tokens", F.explode(F.sequence(F.lit(0), F.size("tokens") - 2)).alias("i"))
        .select(F.concat(left, right).alias("pair"), "n", (F.col("start") + F.col("i")).alias("at"))
    )


def _count_pairs(sequences: DataFrame, any_long: bool = True) -> DataFrame:
    rows = _pair_rows(sequences, any_long)
    return rows.groupBy("pair").agg(F.sum("n").alias("cnt"), F.min("at").alias("first_key"))


def pair_counts(sequences: DataFrame) -> DataFrame:
    """``(left, right, cnt, first_key)`` over all sequences; overlapping pairs all count (``aaa`` has two)."""
    return counted_pairs(sequences)


def top_pairs(counts: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` most frequent pairs, the earliest first on a tie."""
    return counts.orderBy(F.desc("cnt"), F.asc("first_key")).limit(k)


def top_pair(counts: DataFrame) -> DataFrame:
    return top_pairs(counts, 1)


def merge_pair(seq: Column, left: int, right: int, token_id: int) -> Column:
    """Replace a pair by ``token_id``, left to right, without overlap (``aaaa`` gives ``XX``, ``aaa`` gives ``Xa``)."""
    return F.replace(seq, F.lit(id_char(left) + id_char(right)), F.lit(id_char(token_id)))


@dataclass(frozen=True)
class MergeRound:
    """One line of the training record."""

    round: int
    left: int
    right: int
    token_id: int
    cnt: int


def certain_run(leading: list[Row], limit: int) -> list[Row]:
    """The leading pairs that stay in this order whatever the merges before them do (see the module text)."""
    begins: set[str] = set()
    ends: set[str] = set()
    run: list[Row] = []
    for row in leading[:limit]:
        left, right = row["pair"]
        if row["cnt"] < 2 or left in ends or right in begins:
            break
        run.append(row)
        if left == right:
            break
        begins.add(left)
        ends.add(right)
    return run


def untied(leading: list[Row], limit: int) -> list[Row]:
    """The leading pairs of which each occurs more often than the next: their order needs no positions.

    The last of ``limit`` rows may be as frequent as the first one that was not read.
    """
    after = [row["cnt"] for row in leading[1:]] + ([leading[-1]["cnt"]] if len(leading) == limit else [0])
    tie = next((i for i, (row, cnt) in enumerate(zip(leading, after)) if row["cnt"] == cnt), len(leading))
    return leading[:tie]


def _after(seq: Column, merges: list[tuple[int, int, int]]) -> Column:
    """A sequence after some merges, as one compiled expression.

    Its strings are data of the generated code, and merges that do nothing fill it up to a multiple of
    ``MERGES_PER_CODE``, so the JVM compiles a few forms of it and not one a pass.  The generator that callers put around it
    keeps the optimizer from copying the expression into every later use of it.
    """
    for left, right, token_id in merges:
        seq = merge_pair(seq, left, right, token_id)
    for _ in range(-len(merges) % MERGES_PER_CODE):
        seq = F.replace(seq, F.lit(GAP + GAP), F.lit(GAP))
    return seq


def _merged(sequences: DataFrame, counted: list[tuple[int, int, int]], merges: list[tuple[int, int, int]]) -> DataFrame:
    """``(seq, n, start, before)``: the frame with the merges ``counted`` and then ``merges`` applied; ``before`` is what a
    sequence was that the latter change.
    """
    kept = sequences.where(F.length("seq") > 1)
    if counted:
        kept = kept.select("n", "start", F.explode(F.array(_after(F.col("seq"), counted))).alias("seq"))
    changed = kept.select("n", "start", F.col("seq").alias("old"), F.explode(F.array(_after(F.col("seq"), merges))).alias("seq"))
    return changed.select("seq", "n", "start", F.when(F.col("seq") != F.col("old"), F.col("old")).alias("before"))


def _changed_counts(counts: DataFrame, merged: DataFrame, any_long: bool) -> DataFrame:
    """``(pair, cnt)`` after some merges: changed sequences alone give up their old pairs and add their new ones."""
    changed = merged.where(F.col("before").isNotNull())
    sides = F.array(
        F.struct(F.col("before").alias("seq"), (-F.col("n")).alias("n")), F.struct(F.col("seq").alias("seq"), F.col("n").alias("n"))
    )
    rows = changed.select("start", F.explode(sides).alias("side")).select("side.seq", "side.n", "start")
    moved = _pair_rows(rows, any_long).select("pair", F.col("n").alias("cnt"))
    return counts.unionByName(moved).groupBy("pair").agg(F.sum("cnt").alias("cnt")).where("cnt > 0")


def _kept(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def train_sequences(sequences: DataFrame, rounds: int, partitions: int | None = None) -> list[MergeRound]:
    """Up to ``rounds`` merges over weighted sequences; stops when no pair occurs twice."""
    if rounds <= 0:
        return []
    context = sequences.sparkSession.sparkContext
    sequences = materialize(sequences)
    length = F.length("seq")
    rows, longest, tokens = sequences.agg(F.count(F.lit(1)), F.max(length), F.sum(length.cast("bigint"))).first()
    any_long, texts = (longest or 0) > LONG, (tokens or 0) > rows * TEXT_LENGTH
    if partitions is None:
        partitions = max(context.defaultParallelism, -(-rows // SEQUENCES_PER_PARTITION))
    frame = _kept(sequences.select("seq", "n", "start").repartition(partitions))
    counts = None if texts else materialize(_count_pairs(frame, any_long).select("pair", "cnt"))

    def placed(current: DataFrame) -> list[Row]:
        return top_pairs(_count_pairs(current, any_long), LEADING_PAIRS).collect()

    trace: list[MergeRound] = []
    # Merges since the frame was written, and how many of them the counts have.
    pending: list[tuple[int, int, int]] = []
    counted = 0
    while len(trace) < rounds:
        current = _merged(frame, pending[:counted], pending[counted:])
        if counts is None:
            leading = placed(current)
        else:
            if counted < len(pending):
                # Few rows, written each time: cached ones would carry the plans of all passes before.
                counts, counted = materialize(_changed_counts(counts, current, any_long)), len(pending)
            leading = counts.orderBy(F.desc("cnt")).limit(LEADING_PAIRS).collect()
        if not leading or leading[0]["cnt"] < 2:
            break
        ordered = leading if counts is None else untied(leading, LEADING_PAIRS) or placed(current)
        for row in certain_run(ordered, rounds - len(trace)):
            left, right = map(char_id, row["pair"])
            token_id = FIRST_MERGE_ID + len(trace)
            trace.append(MergeRound(len(trace), left, right, token_id, row["cnt"]))
            pending.append((left, right, token_id))
        # A few merges are redone in every pass, which costs less than writing the frame each time, while each pass counts only
        # what its own merges change; then the frame and the counts are rewritten in the shared folder, which bounds the
        # plan and what a lost executor has to redo.
        if len(pending) >= MERGES_PER_REWRITE and len(trace) < rounds:
            current = _merged(frame, pending[:counted], pending[counted:])
            rewritten = _kept(materialize(current.where(F.length("seq") > 1).select("seq", "n", "start")))
            if counts is not None:
                counts = materialize(_changed_counts(counts, current, any_long))
            frame.unpersist()
            frame, pending, counted = rewritten, [], 0
    frame.unpersist()
    return trace


def train_bpe(
    df: DataFrame,
    vocab_size: int,
    pattern: str | None = None,
    text_col: str = "text",
    order_col: str = "doc_id",
    special_tokens: dict[str, int] | None = None,
    partitions: int | None = None,
) -> TokenizerModel:
    """Train a tokenizer on a text column: over whole texts, or inside pre-tokens when ``pattern`` is given.

    ``order_col`` is the corpus order (unique, any BIGINT, hashes as well; see ``dense_order``); it decides ties.
    """
    if not FIRST_MERGE_ID <= vocab_size <= MAX_ID:
        raise ValueError(f"vocab_size must be from {FIRST_MERGE_ID} to {MAX_ID}")
    df = dense_order(df.select(order_col, text_col), order_col)
    if pattern is None:
        sequences = byte_sequences(df, text_col, order_col)
    else:
        sequences = pretoken_sequences(df, pattern, text_col, order_col)
    trace = train_sequences(sequences, vocab_size - FIRST_MERGE_ID, partitions)
    return TokenizerModel(
        merges=[(r.left, r.right, r.token_id) for r in trace],
        pattern=pattern,
        special_tokens=special_tokens,
        trace=trace,
    )
