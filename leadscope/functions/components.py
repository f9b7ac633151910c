"""Connected components of a link table by alternating star steps (a logarithmic number of rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import checkpointed


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node) for every node that has a link.

    Large star: a node's larger neighbours are linked to its smallest neighbour; small star: its smaller neighbours
    and itself are. Both keep what is connected, and end in stars. A node is a row per neighbour, and stars are
    formed by minima with partial aggregation; the centre of a large star is never gathered.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges, state = checkpointed(edges), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = checkpointed(small.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            stars = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        state = now
