"""Connected components of a table of links, by alternating star contractions.

Every round each node points its larger neighbours to the smallest node it knows, then
its smaller ones.  Rounds grow with the logarithm of the longest path.  A hub is only
ever aggregated (combined before the shuffle) and joined with the written least
neighbours, one row a node: broadcast where they are few by count, else by a join that
adaptive execution splits where a node has very many links.  Nothing is gathered, and no
link reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.session import materialize


# Nodes whose least neighbours (16 bytes each) may be broadcast.
FEW_NODES = 500_000


def _least(edges: DataFrame) -> DataFrame:
    """The least neighbour of every node, written: joined as it comes from its aggregate, it
    would share the links' partitioning, and a hub's links could not be split."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = materialize(least, "least")
    return F.broadcast(least) if least.count() <= FEW_NODES else least


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_least(both), "a").filter("b > a AND b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    joined = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.unionByName(least.filter("a != m").select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that a link names.

    ``edges`` has the columns ``a`` and ``b``; loops and NULL ends are passed over.
    """
    current = materialize(edges.select("a", "b").filter("a != b").distinct(), "links")
    state = _state(current)
    while True:
        current = materialize(_small_star(_large_star(current)), "stars")
        after = _state(current)
        if after == state:
            break
        state = after
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
