"""Connected components of an edge table by alternating stars.

Each round hangs every neighbour on the least node in reach, first over larger
neighbours, then over smaller ones; a chain halves with each round.  Only
minima are aggregated (map-side first), so a node with very many edges is never
gathered, and skewed joins are split by the planner.  Rounds are stored in the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge ``a`` - ``b`` (long); the root is
    the least node of its component.  Null ends and loops are left out."""
    spark = edges.sparkSession
    e = (edges.where(F.col("a") != F.col("b"))
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stored(e, "edges")
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        after = stored(small, "edges")
        new = _state(after)
        discard(spark, e)
        e = after
        if new == state:
            break
        state = new
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
