"""Connected components of an edge table by alternating large and small stars.

Each round hangs the larger neighbours of every vertex on the smallest vertex
around it, then the smaller ones, and ends when the edges are stars.  Rounds grow
with the logarithm of a component's diameter; a round reads and writes the edge
table only, and minima are aggregated before they are shuffled.  A vertex with a
great many edges is a skewed join key; minima are written out first so that the
join has an exchange on either side, which Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linemend.llm.base import cut

MOST_ROUNDS = 60


def _is_stars(edges: DataFrame) -> bool:
    """Each vertex u has one edge, and no centre w is a vertex u of another."""
    if not edges.groupBy("u").count().where("count > 1").isEmpty():
        return False
    centres = edges.select(F.col("w").alias("u")).distinct()
    return edges.select("u").join(centres, "u", "left_semi").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, root): the smallest vertex of each component that has an edge, for its
    other vertices; a root has no row.  Null ends and loops are ignored."""
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("w")).distinct()
    e = cut(e)
    for _ in range(MOST_ROUNDS):
        if _is_stars(e):
            return e.select(F.col("u").alias("v"), F.col("w").alias("root"))
        both = e.select(F.col("u").alias("x"), F.col("w").alias("y")).union(e.select(F.col("w").alias("x"), F.col("u").alias("y")))
        least = cut(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")))
        large = cut(both.join(least, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("w")).distinct())
        least = cut(large.groupBy("u").agg(F.min("w").alias("m")))
        small = large.join(least, "u").where("w <> m").select(F.col("w").alias("u"), F.col("m").alias("w"))
        e = cut(small.union(least.select("u", F.col("m").alias("w"))).distinct())
    raise RuntimeError("components did not settle")
