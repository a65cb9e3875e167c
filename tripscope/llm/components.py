"""Connected components of a link table by alternating large and small stars.

In a large star every node hands its larger neighbours its smallest one; in a
small star it hands it to itself and its smaller ones.  Both keep what is
connected; repeated, each component becomes a star around its smallest node,
in a number of rounds that grows with the logarithm of its size.  The smallest
neighbours are written before they are joined, so that a node with very many
links can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import written


def _all_stars(links: DataFrame) -> bool:
    """No node has two roots, no root has a root: one aggregate."""
    ends = links.select(
        F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("child")), F.struct(F.col("b").alias("id"), F.lit(0).alias("child")))).alias("e")
    ).select("e.*")
    nodes = ends.groupBy("id").agg(F.sum("child").alias("up"), F.min("child").alias("low"))
    return nodes.where("up > 1 or (up > 0 and low = 0)").isEmpty()


def stars(links: DataFrame) -> DataFrame:
    """``links``: (a, b), any order, repeats allowed.  (id, root) of every node
    that has a link and is not the smallest of its component."""
    current = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star-links"
    )
    while not _all_stars(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star-least")
        large = written(
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "star-large"
        )
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "star-least")
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "star-small")
    return current.select(F.col("a").alias("id"), F.col("b").alias("root"))
