"""Connected components of an edge table, without gathering any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(a, b) of any orderable type -> (node, root): the smallest node of its
    component for every node that an edge joins to another.

    Alternates large-star (every larger neighbour of a node is hung on the
    smallest node it sees) and small-star (every smaller one) until nothing
    changes; the rounds grow with the logarithm of the number of nodes.  The
    smallest neighbour is a map-side combined minimum and edges meet it in a
    join, so a node with very many neighbours is split like any skewed key.
    Each round is written to the shared folder.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "components")
    before = None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b")).distinct()
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m")).distinct()
        edges = stage(small, "components")
