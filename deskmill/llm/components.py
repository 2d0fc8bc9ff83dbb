"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.session import discard, durable_cut


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for every node with a link to another one.

    ``links`` holds pairs of numbers ``a``, ``b`` in any order; repeats and loops do no harm. Each round hangs the larger
    neighbours of a node on its smallest one, then the smaller ones; it ends when a round changes nothing, after
    about log2 of the longest chain rounds. A hub is never gathered: its smallest neighbour is an aggregate, and the join back
    to its links is one that adaptive execution can split.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, seen = durable_cut(edges), None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = state
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, edges = edges, durable_cut(small.unionAll(lower.select("a", F.col("m").alias("b"))).distinct())
        discard(last)
