"""Connected components of links between longs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaflow.llm.common import stored


def both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def with_least(links: DataFrame) -> DataFrame:
    """a, b and the least neighbour of a, itself included."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return links.join(least, "a")


def components(links: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for every node that ``links`` (a, b) names.

    Large stars hang every greater neighbour of a node on its least neighbour, small stars every smaller one; both keep
    components and shorten paths, and repeat until nothing moves. Only aggregates and joins are used, each state is a
    stored table, and the driver sees two numbers a round. Loops and repeated links do no harm; no links give no rows.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        large = with_least(both_ways(edges)).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").select("a", "b").distinct()
        small = with_least(down)
        edges = stored(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct(),
            "links",
        )
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return leaves.unionByName(roots)
