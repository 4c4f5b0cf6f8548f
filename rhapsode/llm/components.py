"""Connected components of a link table by alternating large-star and small-star steps.

All work is DataFrame joins and aggregations; a node with very many links is pre-aggregated on the map
side (min) and joined by plain equi-joins, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, materialize


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node that a link names; component is the least node reachable.

    Self-links, nulls and repeated links are dropped. An empty table gives an empty table.
    """
    hi, lo = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    edges = materialize(links.where(F.col(a) != F.col(b)).select(hi.alias("hi"), lo.alias("lo")).distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialize(least, "least")  # so that a node of very many links can be split in the join
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        hang = large.join(root, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        new = materialize(hang.union(root.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        drop(edges, least)
        edges = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
