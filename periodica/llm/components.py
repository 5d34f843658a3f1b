"""Connected components of a table of links, by alternating stars.

Large star: every node hands its larger neighbours to the smallest node it knows; small
star: its smaller ones. Links only move to smaller ends, and the tables stay as large as
the links. Minima are aggregated before they are joined back. Those of nodes with more than
HOT links are broadcast (there are at most links / HOT of them, and their number is checked),
so that the links of such a node stay where they are; only the others are joined by shuffle.
The links halve their distance to the root in a few rounds, so the rounds grow with the
logarithm of the largest component and are not bounded otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, stored

HOT = 256  # links of a node that are not joined by shuffle


def minima(links: DataFrame, name: str) -> DataFrame:
    """links (u, v) with m, the least v of each u."""
    least = stored(links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), name)
    hot = checked(least.where(f"n > {HOT}").select("u", F.col("m").alias("hot_m")), f"{name}-hot")
    marked = links.join(hot, "u", "left")
    rest = marked.where("hot_m IS NULL").select("u", "v").join(least.where(f"n <= {HOT}").select("u", "m"), "u")
    return marked.where("hot_m IS NOT NULL").select("u", "v", F.col("hot_m").alias("m")).unionAll(rest.select("u", "v", "m"))


def star(links: DataFrame, large: bool) -> DataFrame:
    """links: u, v with u > v."""
    if large:
        around = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        moved = minima(around, "large-star").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        moved = minima(links, "small-star").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root for each node that has a link: root is the smallest node of its component.

    links: columns a and b (long, in any order; repeats and a = b don't matter).
    """
    ordered = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    now = stored(ordered, "links")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    mark = state(now)
    before = None
    while mark != before:
        now = stored(star(stored(star(now, True), "links"), False), "links")
        before, mark = mark, state(now)
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return stored(now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots), "components")


def state(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v", F.lit(1)) % 1_000_003)).first()
