"""Connected components of a graph that no one machine holds.

Large-star and small-star steps alternate (Kiveris et al., "Connected Components in
MapReduce and Beyond"): the first ties every node's larger neighbours to its smallest one,
the second its smaller neighbours. Both keep the components, and in few rounds only
stars around each component's smallest node are left. Every round is written to the
shared checkpoint folder, so lost executors cost no more than it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measure_rollup.sources.shared import settle


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of a set of edges."""
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("sum")
    ).first()
    return row["n"], row["sum"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    tied = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in ``links`` (two columns of long).

    Links to oneself and links with a null are left out.
    """
    first, second = links.columns
    edges = links.select(
        F.greatest(first, second).alias("a"), F.least(first, second).alias("b")
    ).filter(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col(first) != F.col(second)))
    edges = settle(edges.distinct())
    before = _mark(edges)
    while before[0]:
        edges = settle(_small_star(_large_star(edges)))
        now = _mark(edges)
        if now == before:
            break
        before = now
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(centres)
