"""Reading multiple-choice items from JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.offsets import numbered_lines

ITEM_SCHEMA = (
    "ind INT, activity_label STRING, ctx_a STRING, ctx_b STRING, ctx STRING, split STRING, split_type STRING, "
    "label INT, endings ARRAY<STRING>, source_id STRING"
)


def read_choice_items(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """One row per line, with ``item_id`` as the line number.

    ``path`` may hold ``{split}``.  Lines are read in parallel; a malformed line raises.
    """
    if split is not None:
        path = path.format(split=split)
    lines = numbered_lines(spark.read.text(path), "item_id")
    item = F.from_json("value", ITEM_SCHEMA, {"mode": "FAILFAST"})
    return lines.where(F.trim("value") != "").select("item_id", item.alias("item")).select("item_id", "item.*")
