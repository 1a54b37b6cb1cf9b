"""Connected components of links between long integers, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_lens.sources.scratch import materialize


def _lowest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links`` that isn't its own root; the root is the smallest node.

    Every round hooks the larger neighbours of a node, then the smaller ones, to the
    smallest neighbour, until nothing changes: a number of rounds that is logarithmic in
    the longest chain. Minima combine map-side and the rows of a hot node meet them in a
    join that adaptive execution can split, so no node's neighbours are ever gathered.
    Each round is written to the shared folder. Nulls and self links are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = materialize(edges, "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both).select("u", F.least("u", "m").alias("m"))
        larger = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = materialize(larger, "links")
        low = _lowest(edges)
        smaller = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(smaller.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
