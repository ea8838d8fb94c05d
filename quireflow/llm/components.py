"""Connected components of an edge list, by alternating large-star and small-star passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) for every node of ``edges``; root is the least id of its component.

    Edges may repeat, point either way or be loops; edges with a null end are left out. Each pass is
    an aggregate and a join on the node, both of which spread a hub's edges, and ends in a checkpoint;
    the number of passes grows with the logarithm of the number of nodes.
    """
    edges = checkpoint(edges.select(a, b))  # read twice; finding edges is what costs
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u > v").distinct()
    loops = edges.select(F.col(a).alias("id")).union(edges.select(F.col(b).alias("id"))).where("id is not null").distinct()
    e, before = checkpoint(e), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
        e = checkpoint(small.union(low.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = e.groupBy("u").agg(F.min("v").alias("root"))
    return loops.join(roots, loops["id"] == roots["u"], "left").select("id", F.coalesce("root", "id").alias("root"))
