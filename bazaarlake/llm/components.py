"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.storage import store


def _roots(parents: DataFrame) -> DataFrame:
    """``parents`` (``node``, ``label``), whose labels are nodes too, with the last label that each node leads to."""
    while True:
        jump = parents.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = store(parents.join(jump, "label").select("node", F.col("label").alias("old"), F.col("further").alias("label")), "parents")
        parents = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``label``) of every node of the links (``a``, ``b``): the least node it can reach.

    Each round every node points to its least neighbour, if that is less than itself, and pointers are followed to their end by jumps. Nodes that end alike
    become one, links within them fall away and links between them are counted once, so the table of links shrinks with
    every round, most where many links hold few components together. Rounds are joins and partial aggregates, and each is written. Nodes
    without links don't appear.
    """
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = store(links.select(*ends).where("a <> b").distinct(), "links")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        found = _roots(store(least.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "parents"))
        if labels is None:
            labels = found
        else:
            onward = found.select(F.col("node").alias("label"), F.col("label").alias("further"))
            labels = store(labels.join(onward, "label", "left").select("node", F.coalesce("further", "label").alias("label")), "labels")
        x, y = found.select(F.col("node").alias("a"), F.col("label").alias("x")), found.select(F.col("node").alias("b"), F.col("label").alias("y"))
        named = edges.join(x, "a").join(y, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        edges = store(named.select(*ends).where("a <> b").distinct(), "links")
        if edges.isEmpty():
            return labels
