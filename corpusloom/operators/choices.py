"""Multiple-choice items: rendering, masked scores, predictions, accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.model import TokenizerModel
from corpusloom.operators.codec import encode_pieces, reject_special_tokens


def render_choices(items: DataFrame, model: TokenizerModel, item_col: str = "item_id") -> DataFrame:
    """``(item, ending_idx, tokens, mask, label)``: context plus a space and the ending; mask 1 on the ending.

    A text that holds a special-token literal is refused, as by a strict encoder.  The context is encoded once per
    item, before the endings fan out.
    """
    with_context = items.select(
        item_col,
        "label",
        "endings",
        encode_pieces(reject_special_tokens(F.col("ctx"), model), model).alias("ctx_tokens"),
    )
    endings = with_context.select(
        item_col, "label", "ctx_tokens", F.posexplode("endings").alias("ending_idx", "ending")
    )
    spaced = F.concat(F.lit(" "), reject_special_tokens(F.col("ending"), model))
    encoded = endings.withColumn("ending_tokens", encode_pieces(spaced, model))
    return encoded.select(
        item_col,
        "ending_idx",
        F.concat("ctx_tokens", "ending_tokens").alias("tokens"),
        F.concat(
            F.array_repeat(F.lit(0), F.size("ctx_tokens")), F.array_repeat(F.lit(1), F.size("ending_tokens"))
        ).alias("mask"),
        "label",
    )


def pad_choices(rendered: DataFrame, item_col: str = "item_id", max_len: int | None = None) -> DataFrame:
    """Pad tokens and mask with 0 to the longest ending of the item; ``max_len`` adds a ``fits`` check column."""
    padded = rendered.withColumn("max_len", F.max(F.size("tokens")).over(Window.partitionBy(item_col)))

    def fill(name: str):
        return F.concat(name, F.array_repeat(F.lit(0), F.col("max_len") - F.size(name))).alias(name)

    columns = [item_col, "ending_idx", fill("tokens"), fill("mask"), "max_len", "label"]
    if max_len is not None:
        columns.append((F.col("max_len") <= max_len).alias("fits"))
    return padded.select(*columns)


def shifted_positions(rendered: DataFrame, item_col: str = "item_id") -> DataFrame:
    """``(item, ending_idx, pos, prev, target, mask)``: position ``pos`` predicts the token after it.

    The first token is never a target, the last position predicts nothing.
    """
    steps = F.arrays_zip(
        F.slice("tokens", 1, F.greatest(F.size("tokens") - 1, F.lit(0))).alias("prev"),
        F.slice("tokens", 2, F.greatest(F.size("tokens") - 1, F.lit(0))).alias("target"),
        F.slice("mask", 2, F.greatest(F.size("tokens") - 1, F.lit(0))).alias("mask"),
    )
    return rendered.select(item_col, "ending_idx", F.posexplode(steps).alias("pos", "step")).select(
        item_col,
        "ending_idx",
        "pos",
        F.col("step.prev").alias("prev"),
        F.col("step.target").alias("target"),
        F.col("step.mask").alias("mask"),
    )


def cross_entropy(logits: DataFrame, positions: DataFrame, keys: list[str]) -> DataFrame:
    """``positions`` with ``loss``: cross-entropy of the logits with the same ``keys`` against ``target``.

    ``logits`` holds one row per position: ``(*keys, logits ARRAY<number>)``, from any scorer.  A position without a row,
    or whose target has no logit, raises.
    """
    joined = positions.join(logits.select(*keys, "logits"), keys, "left")
    values = F.col("logits")
    missing = F.raise_error(F.lit("a position has no logits")).cast("double")
    largest = F.when(values.isNull(), missing).otherwise(F.array_max(values).cast("double"))
    total = F.aggregate(
        values, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - F.col("_largest"))
    )
    outside = F.raise_error(F.lit("a token has no logit")).cast("double")
    wanted = F.coalesce(F.get(values, F.col("target")).cast("double"), outside)
    return joined.withColumn("_largest", largest).select(
        *positions.columns, (F.log(total) + F.col("_largest") - wanted).alias("loss")
    )


def sliced_losses(slices: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, loss)``: cross-entropy where the logits of a position come in slices of the vocabulary.

    ``slices`` holds rows ``(*keys, target, first_id, logits ARRAY<number>)``: the logits of the ids from ``first_id`` on, as
    a scorer with a divided output layer gives them.  Each slice becomes its largest logit, the sum of exponentials
    relative to it, and the target's logit if it lies there; only these three numbers are shuffled.  A position whose
    target has no logit, or has one in several slices, raises.
    """
    values = F.col("logits")
    largest = F.array_max(values).cast("double")
    nothing = largest.isNull() | (largest == float("-inf"))
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - F.col("_largest")))
    inside = (F.col("target") >= F.col("first_id")) & (F.col("target") - F.col("first_id") < F.size(values))
    found = F.when(inside, F.get(values, (F.col("target") - F.col("first_id")).cast("int")).cast("double"))
    parts = (
        slices.withColumn("_largest", F.when(~nothing, largest))
        .select(*keys, "_largest", F.when(~nothing, total).alias("_total"), found.alias("_wanted"))
        .groupBy(*keys)
        .agg(
            F.max("_largest").alias("_most"),
            F.collect_list(F.when(~F.isnull("_largest"), F.struct("_largest", "_total"))).alias("_parts"),
            F.max("_wanted").alias("_wanted"),
            F.count("_wanted").alias("_times"),
        )
    )
    whole = F.aggregate("_parts", F.lit(0.0), lambda acc, p: acc + p["_total"] * F.exp(p["_largest"] - F.col("_most")))
    wrong = F.raise_error(F.when(F.col("_times") == 0, "a token has no logit").otherwise("a token has several logits")).cast("double")
    wanted = F.when(F.col("_times") == 1, F.col("_wanted")).otherwise(wrong)
    return parts.select(*keys, (F.log(whole) + F.col("_most") - wanted).alias("loss"))


def sliced_position_losses(slices: DataFrame, rendered: DataFrame, item_col: str = "item_id") -> DataFrame:
    """As :func:`position_losses`, from slices ``(item, ending_idx, pos, first_id, target, logits)``."""
    keys = [item_col, "ending_idx", "pos"]
    joined = shifted_positions(rendered, item_col).join(sliced_losses(slices, keys), keys, "left")
    missing = F.raise_error(F.lit("a position has no logits")).cast("double")
    return joined.select(*keys, F.coalesce("loss", missing).alias("loss"), "mask")


def position_losses(logits: DataFrame, rendered: DataFrame, item_col: str = "item_id") -> DataFrame:
    """``(item, ending_idx, pos, loss, mask)``: cross-entropy of the logits at ``pos`` against the next token."""
    keys = [item_col, "ending_idx", "pos"]
    return cross_entropy(logits, shifted_positions(rendered, item_col), keys).select(*keys, "loss", "mask")


def batch_positions(batches: DataFrame) -> DataFrame:
    """``(rank, batch_index, row, pos, prev, target)`` of materialised batches."""
    steps = F.arrays_zip(F.col("inputs").alias("prev"), F.col("targets").alias("target"))
    keys = ["rank", "batch_index", "row"]
    return batches.select(*keys, F.posexplode(steps).alias("pos", "step")).select(*keys, "pos", "step.*")


def batch_position_losses(logits: DataFrame, batches: DataFrame) -> DataFrame:
    """``(rank, batch_index, row, pos, loss)``: cross-entropy of any scorer's logits on training or validation batches."""
    keys = ["rank", "batch_index", "row", "pos"]
    return cross_entropy(logits, batch_positions(batches), keys).select(*keys, "loss")


def choice_scores(losses: DataFrame, item_col: str = "item_id") -> DataFrame:
    """``(item, ending_idx, sum_loss, avg_loss)`` over the positions whose mask is 1."""
    masked = F.sum(F.col("loss") * F.col("mask"))
    # No masked position gives 0/0: no mean, which ranks last.
    return (
        losses.groupBy(item_col, "ending_idx")
        .agg(masked.alias("sum_loss"), F.sum("mask").alias("n_masked"))
        .withColumn("avg_loss", F.col("sum_loss") / F.nullif(F.col("n_masked"), F.lit(0)))
    )


def _lowest(loss: str):
    ranked = F.struct(F.coalesce(F.col(loss), F.lit(float("inf"))), F.col("ending_idx"))
    return F.min_by("ending_idx", ranked)


def choice_predictions(scores: DataFrame, item_col: str = "item_id") -> DataFrame:
    """``(item, pred, pred_norm)``: the ending with the lowest sum and with the lowest mean, the first on a tie."""
    return scores.groupBy(item_col).agg(_lowest("sum_loss").alias("pred"), _lowest("avg_loss").alias("pred_norm"))


def _counters():
    return (
        F.count(F.lit(1)).alias("num_total"),
        F.coalesce(F.sum((F.col("pred") == F.col("label")).cast("bigint")), F.lit(0)).alias("num_correct"),
        F.coalesce(F.sum((F.col("pred_norm") == F.col("label")).cast("bigint")), F.lit(0)).alias("num_correct_norm"),
    )


def _with_accuracy(counts: DataFrame) -> DataFrame:
    total = F.nullif(F.col("num_total"), F.lit(0))
    return counts.withColumn("acc", F.col("num_correct") / total).withColumn(
        "acc_norm", F.col("num_correct_norm") / total
    )


def choice_accuracy(predictions: DataFrame) -> DataFrame:
    """One row of counts and accuracies from ``(pred, pred_norm, label)``; no items give null accuracies."""
    return _with_accuracy(predictions.agg(*_counters()))


def choice_accuracy_by_rank(predictions: DataFrame, world: int, item_col: str = "item_id") -> DataFrame:
    """Counts per rank (item ``i`` belongs to rank ``i mod world``) and, with a null rank, over all ranks."""
    return _with_accuracy(
        predictions.withColumn("rank", F.pmod(F.col(item_col), F.lit(world))).rollup("rank").agg(*_counters())
    )


def choice_examples(
    items: DataFrame, scores: DataFrame, predictions: DataFrame, n: int = 9, item_col: str = "item_id"
) -> DataFrame:
    """The first ``n`` items: context, each ending with its mean loss, predicted and true label."""
    first = items.select(item_col, "ctx", "endings", "label").orderBy(item_col).limit(n)
    losses = scores.join(F.broadcast(first.select(item_col)), item_col).groupBy(item_col).agg(
        F.sort_array(F.collect_list(F.struct("ending_idx", "avg_loss"))).alias("losses")
    )
    lines = F.transform(
        F.col("losses"),
        lambda row: F.format_string(
            "%d (loss: %.4f) %s", row["ending_idx"], row["avg_loss"], F.get(F.col("endings"), row["ending_idx"])
        ),
    )
    return (
        first.join(losses, item_col)
        .join(predictions.select(item_col, "pred_norm"), item_col)
        .select(
            item_col,
            "ctx",
            lines.alias("endings"),
            F.col("pred_norm").alias("predicted"),
            F.col("label").alias("actual"),
        )
        .orderBy(item_col)
    )
