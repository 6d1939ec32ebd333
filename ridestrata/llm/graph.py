"""Connected components by alternating large and small stars, on tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridestrata.operators.stored import store

ROUNDS = 64


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(_least_neighbour(both), "u").where("v > u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of ``links`` (a, b) the least node it reaches.

    Each round is a few joins over the edges; their number is that of the nodes at
    most after the first, and rounds grow with the logarithm of the component size.
    Edges of a round are written, so a lost executor costs one round only."""
    edges = store(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v"), "edges")
    mark = None
    for _ in range(ROUNDS):
        edges = store(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(now)
    raise RuntimeError("components did not settle")
