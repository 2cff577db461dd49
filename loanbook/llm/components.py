"""Connected components of a graph given by its edges, by smallest label with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import rows_exist, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """Node and root (the smallest node of its component) for every node of `edges` (a, b: long).

    A round takes the smallest label among the neighbours and then the label
    that this one had before, so labels travel about twice as far with every
    round. Labels are written once a round: lineage stays short, and joins with
    a written table let adaptive execution split the rows of a node with very
    many neighbours, or of a label with very many nodes. The labels returned
    are a written table too. Self-loops give components of one node; no edges
    give no rows.
    """
    ends = F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = staged(edges.select(ends), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
        "node", F.least("node", "near").alias("root")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("a"), "root"), "a").groupBy(F.col("b").alias("node")).agg(
            F.min("root").alias("heard")
        )
        told = labels.join(heard, "node").select("node", F.least("root", "heard").alias("step"), "root")
        jump = labels.select(F.col("node").alias("step"), F.col("root").alias("beyond"))
        moved = staged(told.join(jump, "step").select("node", "root", F.least("step", "beyond").alias("now")), "labels")
        labels = moved.select("node", F.col("now").alias("root"))
        if not rows_exist(moved.where("now <> root")):
            return labels
