"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage_table


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge: ``root`` is the smallest node of its component.

    Rounds of two joins: every node takes the smallest label among itself and its neighbours, then the label of that
    label, so the distance covered doubles.  Each round is written to the shared folder; both sides of each join are
    then plain scans, so adaptive execution can split a label that a large part of all nodes has.  The rounds end when
    no label changes; only that count reaches the driver.

    Defined cases: null ends are ignored, loops and repeated edges change nothing, no edges give no rows.
    """
    pairs = edges.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    both = pairs.select(F.col(left).alias("node"), F.col(right).alias("near")).union(
        pairs.select(F.col(right).alias("node"), F.col(left).alias("near"))
    )
    both = stage_table(both.distinct(), "edges")
    labels = stage_table(both.groupBy("node").agg(F.least("node", F.min("near")).alias("root")), "labels")
    while True:
        near = labels.select(F.col("node").alias("near"), F.col("root").alias("offer"))
        offers = both.join(near, "near").groupBy("node").agg(F.min("offer").alias("offer"))
        taken = stage_table(
            labels.join(offers, "node").select("node", F.col("root").alias("old"), F.least("root", "offer").alias("root")), "taken"
        )
        jump = taken.select(F.col("node").alias("root"), F.col("root").alias("further"))
        labels = stage_table(
            taken.join(jump, "root").select("node", F.least("root", "further").alias("root"), (F.col("old") != F.least("root", "further")).alias("moved")),
            "labels",
        )
        if labels.where("moved").isEmpty():
            return labels.select("node", "root")
        labels = labels.select("node", "root")
