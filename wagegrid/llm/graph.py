"""Connected components of links, by stars, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import settings


def _larger_first(links: DataFrame) -> DataFrame:
    return links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """The smallest node reachable from each node of ``links``: (node, component).

    Alternating stars: every node hands its larger neighbours to its smallest one,
    then its smaller ones, until nothing changes (a logarithmic number of rounds for
    usual graphs).  Minima are combined before the shuffle and joins are ones that AQE
    splits, so a node with very many links is no single task.  Each round is written
    to the shared folder.  A node that is the smallest of its component is not
    listed; nodes without links and links with a null end are not either.
    """
    held = links.select(F.col(u).alias("u"), F.col(v).alias("v")).dropna()
    held = settings.written(_larger_first(held).distinct(), "links")
    mark = _mark(held)
    while mark[0]:
        both = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(nearest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(nearest.select("u", F.col("m").alias("v")))
        )
        held = settings.written(small.distinct(), "links")
        now = _mark(held)
        if now == mark:
            break
        mark = now
    return held.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _mark(links: DataFrame) -> tuple:
    """Count and hash of all links: equal when nothing changed."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
