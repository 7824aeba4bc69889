"""Connected components of a link table, by large-star and small-star steps.

Each step is a grouped minimum and a join, so no node's links are gathered in
one place; the steps make every component a star around its smallest node in
a number of rounds that grows with the logarithm of its size. Each round is
written to the shared folder.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest one."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links``: ``(a, b)`` of one orderable type, in any order, repeats and
    loops allowed. Returns ``(node, root)`` for each node that has a link to
    another; ``root`` is the smallest node of its component."""
    links = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = None
    while True:
        links = written(_small_star(_large_star(links)), "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = now
