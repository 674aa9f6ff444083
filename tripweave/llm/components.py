"""Connected components of a table of links, without gathering any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.runtime import land


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the links (a, b), for every
    node that has a link.

    Alternating large-star and small-star steps hang every node under the smallest
    one known, until nothing changes; few rounds even for long chains. A step folds
    the smallest neighbour per node (before the shuffle too) and joins it back, so a
    node with very many links is split like any hot join key. Each round is a written
    table. Nulls and links of a node to itself are ignored; an empty table gives none.
    """
    edges = land(
        links.select(F.col("a").cast("long"), F.col("b").cast("long"))
        .filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        large = land(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = land(
            small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small_star"
        )
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
