"""Connected components of a link table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.session import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, component): for every linked node the smallest node it can reach.

    Alternating star contraction: each node hands its larger neighbours, then its smaller ones, over to the smallest
    neighbour, until only stars are left. That takes a number of rounds that grows with the logarithm of the longest
    path. Rounds are written to the shared folder, nothing is collected; a node with very many neighbours is only a
    skewed join key. Links to itself, repeated links and null ends are ignored.
    """
    ends = links.filter(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col(first) != F.col(second)))
    edges = ends.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).distinct()
    edges = stored(edges, "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .distinct())
        large = stored(large, "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lowest, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(lowest.select("a", F.col("m").alias("b"))).distinct())
        edges = stored(small, "small-star")
        last, state = state, _state(edges)
        if state == last:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
