"""Connected components of a graph of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.helpers import keep


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over rows (a, b) with a > b.

    A vertex with very many neighbours costs a partial minimum and a join that adaptive execution can split.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(least, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .filter("a > b")
        .distinct()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every vertex of `links` (a, b); component is the smallest id that can be reached.

    Null ends and loops are no links. Each round's edges are cut from their lineage; the rounds end when no
    vertex has two different smaller neighbours and no neighbour is itself the larger end of a link.
    """
    edges = keep(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while True:
        after = keep(_stars(edges))
        totals = [
            f.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for f in (edges, after)
        ]
        edges = after
        if tuple(totals[0]) == tuple(totals[1]):
            break
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
