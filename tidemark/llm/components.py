"""Connected components of a table of links, by alternating stars.

Every round points nodes at smaller neighbours; the links shrink to one star
per component in a number of rounds that grows with the logarithm of its size.
Links never leave the executors; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the smallest node around it."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Point a node and its smaller neighbours at the smallest of them.  Links run from large to small here."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    pointed = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pointed.filter("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected(links: DataFrame) -> DataFrame:
    """(node, root): one row per node of ``links`` (u, v) that is not the smallest of its component.

    Links of a node to itself, repeated links and NULL ends change nothing.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u") + F.col("v")).alias("s"))
    links = cut_lineage(links.filter("s IS NOT NULL AND u <> v").drop("s").distinct())
    state = _state(links)
    while state[0]:
        links = cut_lineage(_small_star(_large_star(links)))
        state, before = _state(links), state
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
