"""Connected components by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.session import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for all ends of ``edges`` (a, b); the component is its smallest id.

    Each round points every vertex's larger, then its smaller, neighbours at the
    least one it sees; the number of rounds grows with the logarithm of the
    longest path. Every round is a written table; minima are combined before
    the exchange, so a vertex with many edges is no one task's.
    """
    edges = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    while (now := _state(edges)) != seen:
        seen = now
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        edges = stored(small.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    # Every edge now points at the least vertex of its component.
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
