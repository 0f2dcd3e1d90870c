"""Classification trees as tables: ancestors by a recursive query, propagation of scores, display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.operators.relational import numbered

DEEPEST = 64


def ancestors(nodes: DataFrame, code: str = "code", parent: str = "parent") -> DataFrame:
    """(code, ancestor, hops) for every node and ancestor, itself at 0; a node that is its own parent is a root.

    One recursive query; each step joins what the last one reached, so there are as many as the tree is deep.
    """
    view = f"nodes_{id(nodes)}"
    nodes.select(F.col(code).cast("string").alias("code"), F.when(F.col(parent) != F.col(code), F.col(parent)).cast("string").alias("parent")).createOrReplaceTempView(view)
    return nodes.sparkSession.sql(
        f"""WITH RECURSIVE up(code, ancestor, hops) AS (
              SELECT code, code, 0 FROM {view}
              UNION ALL
              SELECT up.code, n.parent, up.hops + 1 FROM up JOIN {view} n ON up.ancestor = n.code WHERE n.parent IS NOT NULL AND up.hops < {DEEPEST}
            ) SELECT code, ancestor, hops FROM up"""
    )


def load_tree(nodes: DataFrame, code: str, label: str, parent: str) -> DataFrame:
    """code, label, parent, level: a child with its parent's label is merged into the parent, level 0 are roots."""
    rows = nodes.select(F.col(code).cast("string").alias("code"), F.col(label).alias("label"), F.col(parent).cast("string").alias("parent"))
    up = rows.select(F.col("code").alias("parent"), F.col("label").alias("above"), F.col("parent").alias("grand"))
    merged = rows.join(up, "parent", "left").withColumn("same", F.coalesce(F.col("label") == F.col("above"), F.lit(False)))
    gone = merged.where("same").select(F.col("code").alias("parent"), F.col("parent").alias("kept"))
    kept = merged.where("NOT same").join(gone, "parent", "left").select("code", "label", F.coalesce("kept", "parent").alias("parent"))
    levels = ancestors(kept).groupBy("code").agg(F.max("hops").alias("level"))
    return kept.join(levels, "code")


def ancestor_weights(up: DataFrame, rate: float = 0.5) -> DataFrame:
    """(code, other, weight): 1 on the diagonal, rate**hops between a node and its ancestors, both ways; else absent."""
    w = up.select("code", F.col("ancestor").alias("other"), F.pow(F.lit(rate), F.col("hops")).alias("weight"))
    return w.union(up.where("hops > 0").select("ancestor", "code", F.pow(F.lit(rate), F.col("hops"))))


def propagate(scores: DataFrame, up: DataFrame, key: str, alpha: float, rate: float = 0.5, least_level: int = 0, levels: DataFrame | None = None) -> DataFrame:
    """(key, code, score): a node's score and alpha times its ancestors' scores, weighted by rate**hops.

    scores: key, code, score. Ancestors above least_level are left out if levels (code, level) are given.
    """
    edges = up.where("hops > 0")
    if levels is not None:
        edges = edges.join(levels.where(F.col("level") >= least_level).select(F.col("code").alias("ancestor")), "ancestor", "left_semi")
    passed = scores.withColumnRenamed("code", "ancestor").join(edges, "ancestor").select(key, "code", (F.col("score") * F.pow(F.lit(rate), "hops") * alpha).alias("more")).groupBy(key, "code").agg(F.sum("more").alias("more"))
    return scores.join(passed, [key, "code"], "left").select(key, "code", (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))


def passed_down(scores: DataFrame, up: DataFrame, key: str, alpha: float, rate: float = 0.5) -> DataFrame:
    """(key, parent, more): what propagate adds to each child of a node, from scores (key, code, score) of the nodes above. It's the same for all of its children."""
    weight = F.pow(F.lit(rate), F.col("hops") + 1)
    reached = scores.withColumnRenamed("code", "ancestor").join(up.withColumnRenamed("code", "parent"), "ancestor")
    return reached.groupBy(key, "parent").agg(F.sum(F.col("score") * weight * alpha).alias("more"))


def display(tree: DataFrame, up: DataFrame, root: str | None = None) -> DataFrame:
    """place, line: a tree (or one node's part of it) in pre-order, indented by level."""
    path = up.groupBy("code").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("hops")).alias("h"), F.col("ancestor").alias("a")))), lambda x: x["a"]), "/").alias("path"))
    rows = tree.join(path, "code")
    if root is not None:
        rows = rows.join(up.where(F.col("ancestor") == root).select("code"), "code", "left_semi")
    return numbered(rows, ["path"], "place").select(F.col("place").cast("int").alias("place"), F.concat(F.expr("repeat('  ', CAST(level AS INT))"), "code", F.lit(" "), "label").alias("line"))
