"""Connected components by alternating large and small stars over stored edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.session import materialize


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id, component`` of every id in ``links``: the least id it is connected with.

    Each round replaces an id's edges by edges to its least neighbour, so the rounds grow with the
    logarithm of the longest path. Neighbours are reduced by a grouped minimum, never gathered.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges = materialize(edges, "edges")
    before = None
    while before != (before := _checksum(edges)):
        both = edges.union(edges.select("v", "u"))
        # Stored, so that Spark can split the join at an id of very many links.
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        # Large star: larger neighbours go to the least of all neighbours and the id itself.
        large = materialize(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u > v").distinct(), "large-star",
        )
        # Small star: smaller neighbours, and the id, go to the least of them.
        smallest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(
            small.union(smallest.select("u", F.col("m").alias("v"))).filter("u > v").distinct(), "small-star"
        )
    own = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return own.union(roots)
