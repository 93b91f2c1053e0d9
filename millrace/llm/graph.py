"""Connected components of a graph given as edges, by contraction in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node (``node``, ``label``), from edges of two long columns ``a``, ``b``.

    In a round every node is put into its smallest neighbour, if that is smaller, then twice into what that one is
    put into. Edges are moved to the nodes their ends are in, and those within one node fall away, so each round
    joins far fewer of them. Nodes and edges are written after every round; nothing but the question whether edges
    are left comes to the driver. Equal edges and loops are allowed; no edges give no rows.
    """
    labels = written(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("label")), "labels"
    )
    left = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while left.limit(1).count():
        # The larger end of an edge takes the smaller; the smaller is named too, that it may be found.
        ends = left.select("b", F.col("a").alias("into")).union(left.select(F.col("a").alias("b"), F.col("a").alias("into")))
        into = written(ends.groupBy(F.col("b").alias("node")).agg(F.min("into").alias("into")), "into")
        for _ in range(2):
            further = into.select(F.col("node").alias("_at"), F.col("into").alias("_to"))
            into = into.join(further, into["into"] == further["_at"]).select("node", F.col("_to").alias("into"))
        into = written(into, "into")
        moved = labels.join(into, labels["label"] == into["node"], "left")
        labels = written(moved.select(labels["node"], F.coalesce("into", "label").alias("label")), "labels")
        one, other = into.toDF("_n", "_a"), into.toDF("_m", "_b")
        ends = left.join(one, left["a"] == one["_n"]).join(other, left["b"] == other["_m"]).where("_a <> _b")
        left = written(ends.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
    return labels
