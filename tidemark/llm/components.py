"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stored


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node named in ``links`` (a, b); component is the smallest node reachable.

    Alternates the large-star and small-star steps: neighbours move to the least node each knows, by aggregations that
    combine on the map side, until nothing changes. Every round is written to the shared folder; neither nodes nor links
    reach the driver, only one count and one checksum a round.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(rounds):  # each about halves the longest way to a root
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small_min, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_min.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
