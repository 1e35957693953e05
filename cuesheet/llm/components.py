"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a partial aggregation and an equi-join on narrow rows, written to the shared folder;
the driver sees two numbers a round. No neighbourhood is ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b``; root is the smallest node reachable.

    Loops and repeated edges are allowed, nodes without other neighbours may be left out; an
    empty table gives an empty result."""
    e = durable(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "edges")
    state = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        state = now
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = durable(large, "large-star")
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        stars = small.select("hi", F.col("m").alias("lo")).unionByName(
            large.join(small, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        e = durable(stars.distinct(), "edges")
