"""Running totals over a whole table without a one-partition window.

The order key is cut into slices of about equal row counts.  Each slice sums and sorts on its own; only one row per
slice takes part in the global running total.  The slice of a row depends on its key alone, so every branch of the
plan, and every recomputation after a lost executor, agrees on it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage_table

# Bounds on the plan: cut points, cells of a histogram, and passes that split crowded cells.
MAX_SLICES = 32_768
CELLS = 4_096
HISTOGRAM_PASSES = 4
ROWS_PER_SLICE = 200_000
# One row per file or split is broadcast up to this many (about 100 bytes each).
MAX_BROADCAST_ROWS = 1_000_000


def div(a: Column, b: Column | int) -> Column:
    """Whole-number division, exact over the whole of BIGINT (both sides not negative)."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def small_side(rows: DataFrame) -> DataFrame:
    """``rows`` marked for a broadcast if they are counted to be few enough, else as they are."""
    return F.broadcast(rows) if rows.count() <= MAX_BROADCAST_ROWS else rows


def slice_bounds(
    df: DataFrame, order_col: str, slices: int | None = None, weight: Column | None = None, per_slice: int = ROWS_PER_SLICE
) -> list[int]:
    """Cut points of ``order_col`` into slices of about equal row counts, or equal sums of ``weight``.

    Keys are counted in equally wide cells; cells that hold more than two slices are divided and counted again.  A
    pass reads that one column, and the weight, and returns one row for each cell.
    """
    counted = F.lit(1) if weight is None else F.greatest(weight, F.lit(1))
    keys = df.select(order_col, counted.cast("bigint").alias("_weight")).where(F.col(order_col).isNotNull())
    total, low, high = keys.agg(F.sum("_weight"), F.min(order_col), F.max(order_col)).first()
    if not total:
        return []
    wanted = slices or max(df.sparkSession.sparkContext.defaultParallelism, -(-total // per_slice))
    share = -(-total // min(wanted, MAX_SLICES))
    edges = _even(low, high + 1, CELLS)
    for _ in range(HISTOGRAM_PASSES):
        found = keys.groupBy(slice_of(order_col, edges).alias("cell")).agg(F.sum("_weight").alias("n")).collect()
        counts = {row["cell"]: row["n"] for row in found}
        ends = [low, *edges, high + 1]
        crowded = [i for i, n in counts.items() if n > 2 * share and ends[i + 1] - ends[i] > 1]
        if not crowded or len(edges) >= 2 * MAX_SLICES:
            break
        parts = max(2, CELLS // len(crowded))
        edges = sorted(set(edges).union(*(_even(ends[i], ends[i + 1], parts) for i in crowded)))
    bounds, held = [], 0
    for i, edge in enumerate(edges):
        held += counts.get(i, 0)
        if held >= share:
            bounds.append(edge)
            held = 0
    return bounds


def _even(low: int, high: int, parts: int) -> list[int]:
    """Inner cut points of ``[low, high)`` into equally wide parts."""
    return sorted({low + (high - low) * i // parts for i in range(1, parts)} - {low, high})


def slice_of(order_col: str, bounds: list[int]) -> Column:
    """Number of cut points at or below the key, found by halving: about log2(n) comparisons."""
    if not bounds:
        return F.lit(0)
    key = F.col(order_col)
    # A JSON literal: the optimizer folds it into a constant array.
    cuts = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))))

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get(cuts, at + step - 1) <= key, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def running_offset(
    df: DataFrame,
    order_col: str,
    amount: Column,
    out: str = "offset",
    slices: int | None = None,
    weight: Column | None = None,
    per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over all rows with a smaller ``order_col`` (a unique BIGINT).

    All columns travel with the key, so nothing is joined back; where they are large, ``weight`` tells by how much, and
    slices hold about ``per_slice`` of it.  A null key or two equal keys raise: equal keys are neighbours in their slice.
    """
    bounds = slice_bounds(df, order_col, slices, weight, per_slice)
    sliced = df.withColumn("_slice", slice_of(order_col, bounds)).withColumn("_amount", amount.cast("bigint"))
    # One row per slice, at most MAX_SLICES of them: this window may run in one task and its result be broadcast.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        sliced.groupBy("_slice")
        .agg(F.sum("_amount").alias("_total"))
        .select("_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    )
    in_order = Window.partitionBy("_slice").orderBy(order_col)
    inside = in_order.rowsBetween(Window.unboundedPreceding, -1)
    refused = F.raise_error(F.concat_ws(" ", F.lit(f"{order_col} is null or repeated:"), F.col(order_col).cast("string")))
    wrong = F.col(order_col).isNull() | F.coalesce(F.lag(order_col).over(in_order) == F.col(order_col), F.lit(False))
    placed = sliced.withColumn(out, F.coalesce(F.sum("_amount").over(inside), F.lit(0))).withColumn("_wrong", wrong)
    return (
        placed.join(F.broadcast(bases), "_slice")
        .withColumn(out, F.when(F.col("_wrong"), refused.cast("bigint")).otherwise(F.col(out) + F.col("_base")))
        .drop("_slice", "_amount", "_base", "_wrong")
    )


def numbered_lines(lines: DataFrame, out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2, … over a file scan, files by path and rows by their place in the file.

    The scan is staged once with the place of every line, so each split's numbering and its line count come from the
    same reading.  The rows of one split are consecutive in the scan; one row per split takes part in the global
    running total and is broadcast if the splits are few enough, so no text is shuffled.
    """
    split = ["_file", "_block"]
    tagged = stage_table(
        lines.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "lines",
    )
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        tagged.groupBy(*split)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
        .select(*split, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    )
    return (
        tagged.join(small_side(bases), split)
        .withColumn(out, F.col("_base") + F.col("_at") - F.col("_first"))
        .drop("_at", "_first", "_base", *split)
    )
