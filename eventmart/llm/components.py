"""Connected components of a graph given by its edges, by alternating large-star and small-star steps.

Each step replaces a node's edges by edges to its smallest neighbour, so hot nodes are aggregated before
any shuffle; after a logarithmic number of rounds every component is a star around its smallest id.
"""

from pyspark.sql import functions as F

from eventmart.llm.common import stored


def _large(edges):
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small(edges):
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(smallest, "u")
    moved = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smallest.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def star_components(edges):
    """(u, root) for every node that is not the smallest of its component. `edges` has u and v, u > v."""
    edges, before = stored(edges.where("u > v").distinct(), "edges"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select("u", F.col("v").alias("root"))
        before = state
        edges = stored(_small(_large(edges)), "edges")
