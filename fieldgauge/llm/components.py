"""Connected components of a link table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.staging import cut_lineage


def _roots(parents: DataFrame) -> DataFrame:
    """Follow parents up to the roots, doubling the step each time; ``parents`` holds every node."""
    while True:
        up = parents.select(F.col("node").alias("_node"), F.col("parent").alias("_grand"))
        jumped = cut_lineage(
            parents.join(up, F.col("parent") == F.col("_node")).select(
                "node", F.col("_grand").alias("parent"), (F.col("_grand") != F.col("parent")).alias("moved")
            )
        )
        parents = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; a component is named by its least node.

    In each round every node points to its least neighbour, or itself; the trees this makes are
    flattened by pointer doubling, and links between trees are carried on as links between roots. A
    round leaves at most half of the nodes. Aggregates combine on the map side, so a node with very
    many links costs one row per task; joins on it are split by adaptive execution.
    Self links and repeated links do no harm; rows with a NULL end are ignored.
    """
    current = cut_lineage(links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct())
    labels = None
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        roots = _roots(cut_lineage(least.select("node", F.least("node", "least").alias("parent"))))
        if labels is None:
            labels = roots.withColumnRenamed("parent", "component")
        else:
            step = roots.select(F.col("node").alias("component"), "parent")
            labels = labels.join(step, "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")
            )
        labels = cut_lineage(labels)
        ends = roots.select(F.col("node").alias("a"), F.col("parent").alias("_a"))
        other = roots.select(F.col("node").alias("b"), F.col("parent").alias("_b"))
        current = cut_lineage(
            current.join(ends, "a").join(other, "b").filter("_a != _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
        )
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return labels
