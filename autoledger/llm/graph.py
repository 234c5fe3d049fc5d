"""Connected components of an edge table, by joins and sums alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def all_stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour at most, and none if it has larger ones; ``b`` is less than ``a``."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("smaller"), F.lit(1).alias("larger"))
    )
    counts = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return counts.filter("smaller > 1 OR (smaller = 1 AND larger = 1)").isEmpty()


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for edges ``a``, ``b`` of one orderable type.

    Alternates two steps until all components are stars: each node links its larger neighbours to the least of its
    neighbourhood, then its smaller ones. Both keep components, and the number of rounds
    grows with the logarithm of the number of nodes. Each round is written to the shared folder, in ``files``.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), "edges", files)
    while not all_stars(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a"))
        # By node once, for its least neighbour and for the join with it; equal rows go with the other step's.
        large = large.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).repartition("a")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        ends = F.explode(F.array("b", "a")).alias("a")
        small = large.join(least, "a").select(ends, F.col("least").alias("b"))
        edges = stored(small.filter("a <> b").distinct(), "edges", files)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
