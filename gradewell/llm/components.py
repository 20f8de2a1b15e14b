"""Connected components of a graph too large for one machine: alternating large-star and small-star rounds.

Each round is two aggregations and two joins, whose result is stored; few rounds are needed, as every one moves nodes
nearer to the smallest of their component.  The driver sees two numbers per round, no links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b; a > b) that is not the smallest of its component."""
    links = stored(links.select("a", "b").distinct(), "links")
    seen = None
    while True:
        state = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31))).first())
        if state == seen or state[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        links = stored(_small_star(_large_star(links).distinct()).distinct(), "links")
