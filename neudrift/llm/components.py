"""Connected components of a graph of any size, by alternating star contractions."""

from pyspark.sql import DataFrame, functions as F

from neudrift.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Settled, so that adaptive execution can split the links of a hub in the join.
    least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = settle(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`u`, `v` pairs of numbers to `node`, `root`: the smallest number that can be reached.

    Only nodes that are not their own root are returned. Repeated links, both directions and links of a
    node to itself are allowed; links with a null are left out. Each round shuffles the links twice and
    settles them and their ends; the number of rounds grows with the logarithm of the longest path.
    """
    edges = settle(edges.where("u != v").select(F.col("u").cast("long"), F.col("v").cast("long")).distinct())
    while True:
        before = edges
        edges = settle(_small_star(_large_star(edges)))
        if before.exceptAll(edges).isEmpty() and edges.exceptAll(before).isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
