"""Connected components of an edge table, by contraction, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relmod.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each node of an edge can reach.

    Every round, each node points to its smallest neighbour or itself, pointers
    are followed to their ends, and the edges between different ends are the
    next round's. Neighbours are only aggregated (partially, before any
    shuffle), never gathered; joins on a frequent end can be split.
    """
    none = edges.select(F.col(a).alias("node"), F.col(b).alias("root")).limit(0)
    left = stored(_between(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    found = None
    while not left.isEmpty():
        ways = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = stored(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "pointers")
        while True:
            on = to.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            further = stored(to.join(on, F.col("root") == F.col("_n")).select("node", F.col("_r").alias("root"), (F.col("_r") != F.col("root")).alias("_moved")), "pointers")
            to = further.select("node", "root")
            if further.filter("_moved").isEmpty():
                break
        end = to.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        found = to if found is None else stored(
            found.join(end, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root")), "roots"
        )
        there = to.select(F.col("node").alias("_m"), F.col("root").alias("_s"))
        ends = left.join(end, F.col("a") == F.col("_n")).join(there, F.col("b") == F.col("_m"))
        left = stored(_between(ends.select(F.col("_r").alias("a"), F.col("_s").alias("b"))), "edges")
    return none if found is None else found


def _between(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
