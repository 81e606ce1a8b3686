"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchcohort.session import written


# Up to so many links, the least neighbours of their nodes (at most two a link, 40 bytes each) are broadcast.
BROADCAST_LINKS = 1 << 17


def _large(e: DataFrame, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Every neighbour beyond a node is tied to the smallest of the node and its neighbours."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(near(least), F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(e: DataFrame, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    tied = e.join(near(least.withColumnRenamed("u", "at")), F.col("u") == F.col("at")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v")))


def _state(e: DataFrame) -> tuple[int, bool]:
    """How many links there are, and whether they are stars: each node has one smaller neighbour, or larger ones only."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("n"), F.min("up").alias("low"))
    n, open_ = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if((F.col("n") > 1) | (F.col("n") == 1) & (F.col("low") == 0))).first()
    return n, open_ == 0


def stars(links: DataFrame) -> DataFrame:
    """(u, v), written: each node but the smallest of its component, and that smallest one, of links (a, b), a written table.

    Rounds are written to the shared folder and end when all links are stars; stars keep a hub's links in
    separate rows, and sums are made before each shuffle. Rounds grow with the logarithm of the longest chain.
    Links with a null end, or of a node to itself, say nothing.
    """
    e = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    n, done = e.count(), False
    while not done:
        near = F.broadcast if n <= BROADCAST_LINKS else lambda least: least
        e = written(_small(_large(e, near), near).distinct(), "stars")
        n, done = _state(e)
    return e


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (a, b), a written table; a component is named by its smallest node."""
    e = stars(links)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
