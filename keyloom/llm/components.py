"""Connected components by alternating star contractions, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Links in a part, some 4 MB: tables of few links are not kept in many small files.
PART_LINKS = 1 << 18


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches. Nodes without a link to another
    are absent; repeated links, loops and an empty table are fine.

    Each round lets every node link its neighbours to the smallest it knows (first the larger neighbours,
    then the smaller ones); the number of rounds is logarithmic in the longest chain. Only two numbers a
    round reach the driver; the links of a node are never gathered."""
    x, y = F.col(a), F.col(b)
    edges = checkpointed(links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    now = _signature(edges)
    edges = edges.coalesce(max(1, -(-now[0] // PART_LINKS)))
    while now[0]:
        both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.union(least).toDF("u", "v").distinct().coalesce(-(-now[0] // PART_LINKS)))  # never more than before
        last, now = now, _signature(edges)
        if now == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v")).distinct())
