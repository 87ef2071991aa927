"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two grouped minima and two joins on the node. The result of a
round is written to the shared folder, so lineage stays short and lost
executors cost one round at most. Nodes with very many links only send
partial minima, and adaptive execution splits their join partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import stage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Links may repeat, point either way or to themselves. Null ends are
    ignored. An empty table gives an empty table.
    """
    current = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    current = stage(current, "links")
    seen = _signature(current)
    while seen[0]:
        current = stage(_small_star(_large_star(current)), "links")
        now = _signature(current)
        if now == seen:
            break
        seen = now
    # stars now: every row leads from a node to the root of its component
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
