"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leaguelake.session import held


def _with_least(links: DataFrame) -> DataFrame:
    """Links (u, v) with the least neighbour of u as ``least``; the sums are stored, so a node with many links can be split."""
    least = held(links.groupBy("u").agg(F.min("v").alias("least")), "least")
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v); ``root`` is the least node of its component.

    Alternating star contraction: nodes pass their least neighbour to larger neighbours, then to smaller ones, until the
    links no longer change. Rounds grow with the logarithm of a component's size; every round is a stored table.
    """
    links = held(links.filter("u <> v").distinct(), "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = held(
            _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v")).filter("u <> v").distinct(), "large"
        )
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lowered = _with_least(down)
        links = held(
            lowered.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(lowered.select("u", F.col("least").alias("v")))
            .filter("u <> v")
            .distinct(),
            "small",
        )
        row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if before == (row["n"], row["sum"]):
            break
        before = (row["n"], row["sum"])
    leaves = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
