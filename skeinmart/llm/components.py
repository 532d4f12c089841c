"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of every node that has a link; the component is its least node.

    ``links`` has two columns a, b of one ordered type. Each round hangs every
    neighbour of a node on the least node it knows, first the larger neighbours, then
    the smaller ones; the number of rounds grows with the logarithm of the longest chain.
    A round is written to the shared folder, so lineage stays short.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    edges, state = _round(links.where("a <> b").select(hi, lo).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.first("hi")).alias("m"))
        large = both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = large.distinct()
        roots = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(roots, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = small.unionByName(roots.select("hi", F.col("m").alias("lo"))).distinct()
        edges, after = _round(small)
        if after == state:
            break
        state = after
    stars = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _round(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges and a fingerprint of the set."""
    seen = Observation()
    sums = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x"), F.bit_xor(F.xxhash64("lo", "hi")).alias("y")]
    written = materialize(edges.observe(seen, *sums), "stars")
    return written, tuple(seen.get.values())
