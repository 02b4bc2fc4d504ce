"""Connected components by repeated contraction of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that edges(a, b) reach from a node.

    Each round hooks every vertex to its smallest neighbour, follows the hooks
    three times more and maps the edges to the vertices that remain, until no
    edge is left.  A round is one write of jumps and one of edges, so lineage is
    cut safely; labels are the jumps of all rounds, followed once per round.
    An edge of a node with itself gives that node; edges with a null are ignored.
    """
    e = stored(edges.select("a", "b").where("a is not null and b is not null").distinct(), "edges")
    labels = e.select(F.col("a").alias("node")).union(e.select("b")).distinct().withColumn("component", F.col("node"))
    e = e.where("a <> b")
    e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    while True:
        hooks = stored(e.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to")), "hooks")
        if hooks.isEmpty():
            return stored(labels, "labels")
        twice = hooks.alias("x").join(hooks.alias("y"), F.col("x.to") == F.col("y.a")).select(F.col("x.a").alias("old"), F.col("y.to").alias("new"))
        jump = stored(twice.alias("x").join(twice.alias("y"), F.col("x.new") == F.col("y.old")).select(F.col("x.old").alias("old"), F.col("y.new").alias("new")), "jumps")
        labels = stored(labels.join(jump, labels.component == jump.old, "left").select("node", F.coalesce("new", "component").alias("component")), "labels")
        to_a, to_b = (jump.select(F.col("old").alias(x), F.col("new").alias(f"n{x}")) for x in "ab")
        e = e.join(to_a, "a").join(to_b, "b").select(F.col("na").alias("a"), F.col("nb").alias("b")).where("a <> b").distinct()
        e = stored(e, "edges")
