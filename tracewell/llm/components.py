"""Connected components by alternating large and small stars, on tables alone.

Each round hangs every node's larger neighbours, then its smaller ones, on its smallest neighbour; the edges become
stars round the smallest node of each component in a number of rounds that grows with the logarithm of its size.  A
round ends in a stored table; only the number of edges and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node in edges of two long columns, `a` and `b`."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    seen = _state(now)
    while seen[0]:
        now = stored(_small_stars(_large_stars(now)), "edges")
        state = _state(now)
        if state == seen:
            break
        seen = state
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], int(r["h"] or 0)


def _large_stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hung = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.filter("a <> b").distinct()


def _small_stars(edges: DataFrame) -> DataFrame:
    """Every edge has its smaller node in `b`."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
