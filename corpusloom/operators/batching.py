"""Token shards to (batch, sequence) rows, as an arithmetic plan and one join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.packed import packed_size, packed_slice, unpacked_ids
from corpusloom.operators.packing import has_packed_tokens, size_of_tokens
from corpusloom.plans.offsets import div, small_side

# Tokens that are put together in one go: a piece is cut into stretches of about as many, or of one row, and not row by row.
TOKENS_PER_STRETCH = 1_024


def rank_totals(manifest: DataFrame, batch_size: int, seq_len: int, world: int) -> DataFrame:
    """``(shard, rank, batches, first_index)`` from ``(shard, n_tokens)``: one row per shard and rank.

    A rank always takes its first batch of a shard and goes on while the next one ends before the last token.
    ``first_index`` is the running batch number of the rank at the start of the shard; the window runs over the rows
    of the manifest, not over batches.
    """
    n = batch_size * seq_len
    per_rank = manifest.select(
        "shard", F.col("n_tokens"), F.explode(F.sequence(F.lit(0), F.lit(world - 1))).alias("rank")
    )
    ahead = F.col("rank") * F.lit(n) + n + 1  # tokens needed for the first batch of the rank
    further = div(F.col("n_tokens") - ahead + n * world - 1, n * world)
    short = F.raise_error(F.lit("a shard is shorter than the first batch of a rank")).cast("bigint")
    batches = F.when(F.col("n_tokens") < ahead, short).otherwise(F.greatest(F.lit(1), further))
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return per_rank.withColumn("batches", batches.cast("bigint")).select(
        "shard", "rank", "batches", F.coalesce(F.sum("batches").over(earlier), F.lit(0)).alias("first_index")
    )


def batch_plan(manifest: DataFrame, batch_size: int, seq_len: int, world: int = 1) -> DataFrame:
    """``(rank, batch_index, shard, start)`` of one pass over the shards, for every rank."""
    n = batch_size * seq_len
    return (
        rank_totals(manifest, batch_size, seq_len, world)
        .select("shard", "rank", "first_index", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)).alias("k"))
        .select(
            "rank",
            (F.col("first_index") + F.col("k")).alias("batch_index"),
            "shard",
            ((F.col("rank") + F.col("k") * F.lit(world)) * F.lit(n)).cast("bigint").alias("start"),
        )
    )


def epochs(plan: DataFrame, steps: int, restart_every: int | None = None) -> DataFrame:
    """``(epoch, rank, batch_index, shard, start)`` for ``steps`` batches per rank; after the last shard the first
    one follows again.  ``batch_index`` keeps counting.

    With ``restart_every`` each rank goes back to its first batch after so many of them, as a loader that is reset does;
    ``epoch`` counts the passes since the last restart.
    """
    span = steps if restart_every is None else restart_every
    if span < 1 <= steps:
        raise ValueError("restart_every must be at least 1")
    totals = plan.groupBy("rank").agg(F.count(F.lit(1)).alias("total"))
    last_epoch = div(F.lit(min(span, steps)) - 1 - F.col("batch_index"), F.col("total"))
    place = F.col("epoch") * F.col("total") + F.col("batch_index")
    runs = (
        plan.where(F.col("batch_index") < min(span, steps))
        .join(F.broadcast(totals), "rank")  # one row per rank
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_epoch)).alias("epoch"))
        .select(F.col("epoch").cast("int").alias("epoch"), "rank", place.alias("place"), "shard", "start")
    )
    last_round = div(F.lit(steps - 1).cast("bigint") - F.col("place"), max(span, 1))
    return runs.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_round)).alias("round")).select(
        "epoch", "rank", (F.col("round") * span + F.col("place")).alias("batch_index"), "shard", "start"
    )


def validation_batches(plan: DataFrame, batches: int = 20) -> DataFrame:
    """The first batches of each rank, from the first shard on, as before each validation."""
    return epochs(plan, batches)


def accumulation_steps(batch_tokens: int, batch_size: int, seq_len: int, world: int) -> int:
    """Micro-batches per optimizer step; the token budget of a step must divide exactly."""
    per_round = batch_size * seq_len * world
    if batch_tokens <= 0 or batch_tokens % per_round:
        raise ValueError(f"{batch_tokens} tokens per step are not a multiple of {per_round}")
    return batch_tokens // per_round


def with_steps(plan: DataFrame, batch_tokens: int, batch_size: int, seq_len: int, world: int) -> DataFrame:
    """Add ``(step, micro)``: the optimizer step of a batch and its place in that step."""
    accum = F.lit(accumulation_steps(batch_tokens, batch_size, seq_len, world)).cast("bigint")
    return plan.withColumn("step", div(F.col("batch_index"), accum)).withColumn(
        "micro", F.col("batch_index") % accum
    )


def step_plan(plan: DataFrame, batch_tokens: int, batch_size: int, seq_len: int, world: int) -> DataFrame:
    """Per optimizer step: micro-batches over all ranks, tokens, and whether the step is full."""
    tokens = F.count(F.lit(1)) * F.lit(batch_size * seq_len)
    return (
        with_steps(plan, batch_tokens, batch_size, seq_len, world)
        .groupBy("step")
        .agg(F.count(F.lit(1)).alias("micro_batches"), tokens.alias("tokens"))
        .withColumn("full", F.col("tokens") == batch_tokens)
    )


def _cut(tokens: Column, start: Column, length: Column, packed: bool) -> Column:
    return packed_slice(tokens, start, length) if packed else F.slice(tokens, (start + 1).cast("int"), length.cast("int"))


def _size(tokens: Column, packed: bool) -> Column:
    return packed_size(tokens) if packed else F.size(tokens)


def _joined(parts: Column, packed: bool) -> Column:
    """The tokens of an array of parts, one after another."""
    if not packed:
        return F.flatten(parts)
    return F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part))


def token_stretches(shards: DataFrame, length: int) -> DataFrame:
    """``(shard, stretch, begin, end, ids)``: tokens ``stretch*L .. stretch*L+L`` of a shard, L+1 of them but at its end.

    The token at a multiple of L closes one stretch and opens the next, so that targets need no look at the next row.
    The shuffle key is the stretch: no task ever holds a whole shard.  Where pieces are missing there is a row for each
    run without a gap, from ``begin`` to before ``end``; where they lie over each other there is none.
    """
    packed = has_packed_tokens(shards)
    size = F.lit(length).cast("bigint")
    begin = F.col("shard_pos")
    end = begin + size_of_tokens(shards)
    first = F.greatest(div(begin + size - 1, size) - 1, F.lit(0))
    pieces = shards.where(size_of_tokens(shards) > 0).select(
        "shard", "shard_pos", "tokens", F.explode(F.sequence(first, div(end - 1, size))).alias("stretch")
    )
    left = F.greatest(F.col("stretch") * size, begin)
    right = F.least((F.col("stretch") + 1) * size + 1, end)
    # Never below 0, also for rows that a pushed-down filter on the stretch looks at before it drops them.
    taken = F.greatest(right - left, F.lit(0)).cast("int")
    part = _cut(F.col("tokens"), left - begin, taken, packed)
    found = (
        pieces.select("shard", "stretch", left.alias("left"), part.alias("part"))
        .where(_size(F.col("part"), packed) > 0)
        .groupBy("shard", "stretch")
        .agg(F.sort_array(F.collect_list(F.struct("left", F.col("part").alias("ids")))).alias("parts"))
    )

    def end_of(run: Column) -> Column:
        return run["left"] + _size(run["ids"], packed)

    def longer(runs: Column, part: Column) -> Column:
        last = F.element_at(runs, -1)
        joined = F.struct(last["left"].alias("left"), _joined(F.array(last["ids"], part["ids"]), packed).alias("ids"))
        others = F.slice(runs, F.lit(1), F.size(runs) - 1)
        return F.when(end_of(last) == part["left"], F.concat(others, F.array(joined))).otherwise(F.concat(runs, F.array(part)))

    start = F.get("parts", F.lit(0))["left"]
    last = F.aggregate("parts", start, lambda at, p: F.when(p["left"] >= at, end_of(p)))  # null from an overlap on
    count = F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + _size(p["ids"], packed))
    whole = F.struct(start.alias("left"), _joined(F.transform("parts", lambda p: p["ids"]), packed).alias("ids"))
    loose = F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), F.slice("parts", 1, 1), longer)
    runs = F.when(last - start == count, F.array(whole)).when(last.isNotNull(), loose)
    return found.select("shard", "stretch", F.explode(runs).alias("run")).select(
        "shard", "stretch", F.col("run.left").alias("begin"), end_of(F.col("run")).alias("end"), F.col("run.ids").alias("ids")
    )


def materialize_batches(shards: DataFrame, plan: DataFrame, batch_size: int, seq_len: int) -> DataFrame:
    """``(epoch, rank, batch_index, row, shard, inputs, targets)``: targets are the inputs one token later.

    Only pieces in the planned part of each planned shard are cut, into stretches of several rows, which are joined and
    then cut into rows.  A planned row whose tokens are missing or too few raises.  Tokens may be packed.
    """
    packed = has_packed_tokens(shards)
    per_stretch = max(1, TOKENS_PER_STRETCH // seq_len)
    length, size = F.lit(seq_len).cast("bigint"), F.lit(seq_len * per_stretch).cast("bigint")
    if "epoch" not in plan.columns:
        plan = plan.withColumn("epoch", F.lit(0))
    rows = plan.select(
        "epoch",
        "rank",
        "batch_index",
        "shard",
        F.posexplode(
            F.transform(F.sequence(F.lit(0), F.lit(batch_size - 1)), lambda r: div(F.col("start"), length) + r)
        ).alias("row", "chunk"),
    ).withColumn("stretch", div(F.col("chunk"), per_stretch))
    # One row per shard: small beside the pieces, and a key of the shards' folders.
    first, last = F.min(div(F.col("start"), size)), F.max(div(F.col("start"), length)) + F.lit(batch_size - 1)
    planned = plan.groupBy("shard").agg(first.alias("_first"), last.alias("_last"))
    inside = (F.col("shard_pos") < (F.col("_last") + 1) * length + 1) & (
        F.col("shard_pos") + size_of_tokens(shards) > F.col("_first") * size
    )
    needed = shards.join(small_side(planned), "shard").where(inside).drop("_first", "_last")
    stretches = token_stretches(needed, seq_len * per_stretch)
    missing = F.raise_error(F.lit("a planned row is not in the shards")).cast("binary" if packed else "array<int>")
    ahead = F.col("chunk") * length - F.col("begin")
    inside = (ahead >= 0) & (F.col("chunk") * length < F.col("end"))
    cut = rows.join(stretches, [rows["shard"] == stretches["shard"], rows["stretch"] == stretches["stretch"], inside], "left")
    keys = ("epoch", "rank", "batch_index", "row", "shard")
    # The generator keeps the cut in front of the conversion, which else takes the whole stretch along with each row.
    found = F.explode(F.array(_cut(F.col("ids"), ahead, length + 1, packed))).alias("_found")
    row = cut.select("epoch", "rank", "batch_index", "row", rows["shard"], found)
    ids = F.when(_size(F.col("_found"), packed) == seq_len + 1, F.col("_found")).otherwise(missing)

    def taken(start: int) -> Column:
        part = _cut(ids, F.lit(start), F.lit(seq_len), packed)
        return unpacked_ids(part) if packed else part

    return row.select(*keys, taken(0).alias("inputs"), taken(1).alias("targets"))
