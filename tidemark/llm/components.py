"""Connected components by rounds of hooking, pointer jumping and contraction; every step is a few joins and one small table in the
shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise


def jumped(hooks: DataFrame) -> DataFrame:
    """Every node (_at) with the end of its chain of hooks (_to): chains double in each step until nothing moves."""
    while True:
        upper = hooks.select(F.col("_at").alias("_mid"), F.col("_to").alias("_end"))
        longer = hooks.join(upper, F.col("_to") == F.col("_mid")).select("_at", F.col("_end").alias("_to"), (F.col("_to") != F.col("_end")).alias("_moved"))
        longer = materialise(longer, "jumps")
        discard(hooks)
        hooks = longer
        if hooks.where("_moved").isEmpty():
            return hooks


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), ids being longs; the root is one node of the component.

    In each round every node hooks to its smallest neighbour, if that is smaller, chains of hooks are followed to their ends, and
    links are drawn between these. Every round ends with fewer nodes, and a path or a star of any size is gone after two or three.
    A node with many links is only ever an aggregation key or the skewed side of a join, never one task's list."""
    links = materialise(links.where("a <> b").select("a", "b").distinct(), "links")
    roots = materialise(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while not links.isEmpty():
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = jumped(materialise(both.groupBy("a").agg(F.min("b").alias("_least")).select(F.col("a").alias("_at"), F.least("a", "_least").alias("_to")), "hooks"))
        old_roots, old_links = roots, links
        roots = materialise(roots.join(hooks, F.col("root") == F.col("_at"), "left").select("node", F.coalesce("_to", "root").alias("root")), "roots")
        left = links.join(hooks, F.col("a") == F.col("_at")).select(F.col("_to").alias("a"), "b")
        right = left.join(hooks, F.col("b") == F.col("_at")).select("a", F.col("_to").alias("b"))
        links = materialise(right.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        discard(old_roots, old_links, hooks)
    discard(links)
    return roots
