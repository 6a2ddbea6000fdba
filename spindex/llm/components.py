"""Connected components of a large graph by alternating stars.

Each round, every node hangs its larger neighbours on its smallest neighbour
(large star), then its smaller neighbours and itself (small star), until
nothing changes; then every node points at the smallest node of its component.
A round is two grouped minima with a join each, written to the shared folder.
A node with very many links is joined by broadcast; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, saved


def hung(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Every edge's ``b`` with the minimum ``m`` of its ``a``."""
    return lookup_join(edges, saved(least, "star-minima"), "a", "n", "inner")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
    return hung(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = hung(edges, least).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node that has an edge and isn't its component's smallest, with that smallest node."""
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where("a > b").distinct(), "star-edges")
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.crc32(F.expr(
            "cast(concat(a, ':', b) as binary)")))).first()
        if seen == state or not seen[0]:
            return now
        state = seen
        now = saved(small_star(large_star(now)).distinct(), "star-edges")
