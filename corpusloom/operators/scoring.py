"""Next-token scores from counts, validation loss, and the training step log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.choices import shifted_positions


def bigram_counts(token_rows: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``(prev, next, n)`` over adjacent tokens of each row; combined on the map side before the shuffle."""
    tokens = F.col(tokens_col)
    following = F.greatest(F.size(tokens) - 1, F.lit(0))
    pairs = F.arrays_zip(
        F.slice(tokens, F.lit(1), following).alias("prev"), F.slice(tokens, F.lit(2), following).alias("next")
    )
    return (
        token_rows.select(F.explode(pairs).alias("pair"))
        .groupBy(F.col("pair.prev").alias("prev"), F.col("pair.next").alias("next"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def stream_bigram_counts(shards: DataFrame) -> DataFrame:
    """``(prev, next, n)`` over the stream of each shard: also across the border of two documents, as batches read it.

    The pairs inside pieces are counted as they are; for the borders only the first and last token of each piece take
    part.
    """
    filled = shards.where(F.size("tokens") > 0)
    ends = filled.select("shard", "shard_pos", F.get("tokens", F.lit(0)).alias("first"), F.element_at("tokens", -1).alias("prev"))
    following = Window.partitionBy("shard").orderBy("shard_pos")
    borders = ends.select("prev", F.lead("first").over(following).alias("next")).where(F.col("next").isNotNull())
    inside = bigram_counts(filled)
    across = borders.groupBy("prev", "next").agg(F.count(F.lit(1)).alias("n"))
    return inside.unionByName(across).groupBy("prev", "next").agg(F.sum("n").alias("n"))


def bigram_logits(bigrams: DataFrame, vocab_size: int) -> DataFrame:
    """``(prev, logits)``: add-one smoothed log counts as a dense row per previous token.

    A row is ``vocab_size`` numbers, the output of one scorer position; use :func:`bigram_losses` for the losses alone.
    It is put together from the tokens seen, in order, and runs of zeros between them.
    """
    seen = F.sort_array(F.collect_list(F.struct("next", "n")))
    rows = bigrams.where(F.col("next") < vocab_size).groupBy("prev").agg(seen.alias("seen"))
    before = F.concat(F.array(F.lit(-1)), F.transform("seen", lambda s: s["next"]))

    def run(entry, last):
        zeros = F.array_repeat(F.lit(0.0), F.greatest(entry["next"] - last - 1, F.lit(0)).cast("int"))
        return F.concat(zeros, F.array(F.log((entry["n"] + 1).cast("double"))))

    runs = F.zip_with("seen", F.slice(before, F.lit(1), F.size("seen")), run)
    rest = F.array_repeat(F.lit(0.0), (F.lit(vocab_size - 1) - F.element_at(before, -1)).cast("int"))
    return rows.select("prev", F.concat(F.flatten(runs), rest).alias("logits"))


def _smoothed_loss(vocab_size: int):
    seen = F.coalesce(F.col("n"), F.lit(0)) + F.lit(1)
    total = F.coalesce(F.col("n_prev"), F.lit(0)) + F.lit(vocab_size)
    return -F.log(seen / total)


def bigram_losses(positions: DataFrame, bigrams: DataFrame, vocab_size: int) -> DataFrame:
    """Add ``loss`` to rows with ``(prev, target)``: ``-ln((n(prev, target) + 1) / (n(prev) + vocab_size))``.

    Distinct pairs are scored once; a pair that fills much of the table is then one row of the lookup.
    """
    totals = bigrams.groupBy("prev").agg(F.sum("n").alias("n_prev"))
    wanted = positions.select("prev", "target").distinct()
    scored = (
        wanted.join(bigrams.withColumnRenamed("next", "target"), ["prev", "target"], "left")
        .join(totals, "prev", "left")
        .select("prev", "target", _smoothed_loss(vocab_size).alias("loss"))
    )
    return positions.join(scored, ["prev", "target"])


def bigram_scores(rendered: DataFrame, bigrams: DataFrame, vocab_size: int, item_col: str = "item_id") -> DataFrame:
    """``(item, ending_idx, pos, loss, mask)`` for rendered choices: a stand-in for a model's forward pass."""
    scored = bigram_losses(shifted_positions(rendered, item_col), bigrams, vocab_size)
    return scored.select(item_col, "ending_idx", "pos", "loss", "mask")


def batch_losses(batches: DataFrame, bigrams: DataFrame, vocab_size: int) -> DataFrame:
    """``(rank, batch_index, loss_sum, n)`` of materialised batches.

    Equal pairs of a batch are counted before the lookup, so the join sees each pair of a batch once.
    """
    pairs = F.arrays_zip(F.col("inputs").alias("prev"), F.col("targets").alias("target"))
    counted = (
        batches.select("rank", "batch_index", F.explode(pairs).alias("pair"))
        .groupBy("rank", "batch_index", F.col("pair.prev").alias("prev"), F.col("pair.target").alias("target"))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return (
        bigram_losses(counted, bigrams, vocab_size)
        .groupBy("rank", "batch_index")
        .agg(F.sum(F.col("loss") * F.col("times")).alias("loss_sum"), F.sum("times").alias("n"))
    )


def validation_loss(losses: DataFrame) -> DataFrame:
    """One row: the mean over batches of the mean token loss, averaged over ranks."""
    per_batch = losses.withColumn("loss", F.col("loss_sum") / F.col("n"))
    per_rank = per_batch.groupBy("rank").agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("batches"))
    return per_rank.agg(
        F.avg("loss").alias("val_loss"), F.sum("batches").alias("batches"), F.count(F.lit(1)).alias("ranks")
    )


def step_log_report(log: DataFrame, batch_size: int, seq_len: int, accum: int, world: int) -> DataFrame:
    """Per step of ``(step, loss, t0, t1)``: mean loss, elapsed milliseconds, tokens per second."""
    tokens = batch_size * seq_len * accum * world
    micros = F.unix_micros(F.max("t1").cast("timestamp")) - F.unix_micros(F.min("t0").cast("timestamp"))
    return (
        log.groupBy("step")
        .agg(F.avg("loss").alias("loss"), micros.alias("micros"))
        .select(
            "step",
            "loss",
            (F.col("micros") / F.lit(1000.0)).alias("elapsed_ms"),
            (F.lit(tokens * 1e6) / F.nullif(F.col("micros"), F.lit(0))).alias("tokens_per_sec"),
        )
    )
