"""Connected components of a large graph by contraction, with DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import written


def jumped(parents: DataFrame) -> DataFrame:
    """Replace every parent by its parent's parent."""
    up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
    return (parents.join(up, "parent", "left")
            .select("node", F.coalesce("top", "parent").alias("parent"),
                    (F.col("top").isNotNull() & (F.col("top") != F.col("parent"))).alias("moved")))


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (``a``, ``b``: long): ``node, component``.

    Each round hooks every node to its smallest neighbour, follows the chains of parents to their roots by pointer
    jumping, and contracts the edges to the roots. Every node with a smaller neighbour stops being a root, so the
    nodes of a component with edges at least halve in a round; a chain is followed in logarithmically many jumps.
    Tables are written between the steps, so plans stay short and a lost executor costs one step. Nodes without
    an edge to another node do not appear.
    """
    spark = edges.sparkSession
    edges = written(spark, edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "cc-edges")
    labels = None
    while edges.take(1):
        # the larger end hooks; the smaller end is listed so that roots are known
        hooked = (edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")))
        parents = written(spark, hooked.withColumn("moved", F.lit(True)), "cc-parents")
        while parents.where("moved").take(1):
            parents = written(spark, jumped(parents.select("node", "parent")), "cc-parents")
        parents = parents.select("node", "parent")
        if labels is None:
            nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
            labels = written(spark, nodes.join(parents, "node", "left")
                             .select("node", F.coalesce("parent", "node").alias("parent")), "cc-labels")
        else:
            labels = written(spark, labels.join(parents.select(F.col("node").alias("parent"),
                                                               F.col("parent").alias("top")), "parent", "left")
                             .select("node", F.coalesce("top", "parent").alias("parent")), "cc-labels")
        top = parents.select(F.col("node"), F.col("parent").alias("top"))
        step = (edges.join(top.withColumnRenamed("node", "a").withColumnRenamed("top", "ta"), "a", "left")
                .join(top.withColumnRenamed("node", "b").withColumnRenamed("top", "tb"), "b", "left")
                .select(F.coalesce("ta", "a").alias("a"), F.coalesce("tb", "b").alias("b")))
        edges = written(spark, step.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "cc-edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.select("node", F.col("parent").alias("component"))
