"""Connected components of a link table by alternating stars.

Each round links every node's larger neighbours, then all its smaller ones, to the
smallest node around it; only minima are aggregated, never adjacency lists, so a hub
with very many links is no heavier than others. Rounds grow with the logarithm of the
longest chain. Every round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b): returns (id, component), the smallest id reachable, for each id that
    another one leads to; ids without links to a smaller one in their component are the
    component's name themselves and are not returned. Self-links and repeats are harmless."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = staged(small, "stars")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = state
