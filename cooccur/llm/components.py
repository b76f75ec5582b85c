"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cooccur.llm.frames import freeze


def _hooked(links: DataFrame) -> DataFrame:
    """Every node with the least node next to it, where that is less than itself."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy("a").agg(F.min("b").alias("b")).where("b < a")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the least node that it is connected with.

    Each round hooks every node to its least neighbour, follows those hooks to their ends by
    doubling, and contracts the links to the ends. The hooks form trees, as each goes to a
    smaller node, and every node with a smaller neighbour disappears, so links shrink by a
    factor each round; all steps are joins on unique keys and aggregations that combine before
    their shuffle. Tables are written between rounds, so lineage stays short.
    """
    links = freeze(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = freeze(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node")))
    while links.head(1):
        hooks = freeze(_hooked(links))
        while True:
            onward = hooks.select(F.col("a").alias("b"), F.col("b").alias("_to"))
            longer = freeze(hooks.join(onward, "b", "left").select(
                "a", F.coalesce("_to", "b").alias("b"), F.col("_to").isNotNull().alias("_moved")))
            hooks = longer.select("a", "b")
            if not longer.where("_moved").head(1):
                break
        to = hooks.withColumnRenamed("b", "_to")
        roots = freeze(roots.join(to, roots["root"] == to["a"], "left").select("node", F.coalesce("_to", "root").alias("root")))
        for end in ("a", "b"):
            moved = to.withColumnRenamed("a", end)
            links = links.join(moved, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
        links = freeze(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return roots
