"""Connected components of an edge table, by rounds of smallest neighbours and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.llm.common import materialise


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that each node of edges (a, b) can reach, itself included.

    Every round each root takes the smallest root next to it, pointers are then halved, and edges are drawn between
    roots anew; edges inside a component go. The rounds are logarithmic in the longest path, each writes its tables in
    the shared folder, and only a count reaches the driver. A node with many edges is reduced before each shuffle.
    """
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), name)
    labels = materialise(edges.select("a").union(edges.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("component")), name)
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        hooks = materialise(both.groupBy("a").agg(F.min("b").alias("up")).select(F.col("a").alias("root"), F.least("a", "up").alias("up")), name)
        while True:  # pointers to pointers, until every root points at one that points at itself
            next_up = hooks.select(F.col("root").alias("up"), F.col("up").alias("far"))
            jumped = materialise(hooks.join(next_up, "up").select("root", F.col("far").alias("up"), (F.col("far") != F.col("up")).alias("moved")), name)
            hooks = jumped.select("root", "up")
            if not jumped.where("moved").head(1):
                break
        to = hooks.withColumnRenamed("root", "component")
        labels = materialise(labels.join(to, "component", "left").select("node", F.coalesce("up", "component").alias("component")), name)
        one, two = hooks.select(F.col("root").alias("a"), F.col("up").alias("x")), hooks.select(F.col("root").alias("b"), F.col("up").alias("y"))
        edges = materialise(
            edges.join(one, "a").join(two, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct(), name
        )
        if not edges.head(1):
            return labels
