"""Connected components of a graph given as an edge table.

Large-star / small-star rounds (Kiveris et al., 2014): each round points every
node at smaller neighbours until all edges are stars around the smallest node
of their component. Each round is written to the shared folder, so lineage
stays short and a lost executor costs a re-read. Only edges move; the driver sees two
counts of at most one a round. Rounds grow with the logarithm of the longest
path. A hub's minimum is pre-aggregated; its join is one that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import stored


def _with_minimum(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` with ``m``, the smallest of ``a`` and its neighbours."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return edges.join(least, "a")


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(a, b)`` links -> ``(a, root)`` for every linked node that isn't itself a root, root the smallest node."""
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = stored(links, f"{name}-links")
    while True:
        several = links.groupBy("a").count().where("count > 1")
        chained = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        if not several.limit(1).count() and not chained.limit(1).count():
            return links.select("a", F.col("b").alias("root"))  # every node points at a root
        both = links.union(links.select("b", "a"))
        large = _with_minimum(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = _with_minimum(large.where("a <> b").distinct())
        out = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        links = stored(out.where("a <> b").distinct(), f"{name}-links")
