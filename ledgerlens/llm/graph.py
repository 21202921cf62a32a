"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to its smallest one."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node sends its smaller neighbours and itself to the smallest one."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (columns ``u`` and ``v``, integers) but the smallest of its component.

    The number of rounds grows with the logarithm of the longest chain. Each round is written to the shared folder; two numbers
    that tell whether it changed anything reach the driver. Smallest neighbours are partial aggregates, and a hub's links are split by
    adaptive execution where they are joined back.
    """
    stars = materialize(
        links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    told = F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
    before = stars.agg(*told).first()
    while before["n"]:
        stars = materialize(_small_star(_large_star(stars).distinct()).distinct(), "links")
        after = stars.agg(*told).first()
        if after == before:
            break
        before = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
