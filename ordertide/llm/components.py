"""Connected components of a link table by large-star and small-star rounds.

Each round is one shuffle per star; the number of rounds grows with the logarithm of the
longest path. A node with very many links is only ever joined against one row (its smallest
neighbour), so it is never gathered in one task. Every round is cut off by a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import durable


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link; ``component`` is the smallest node reachable.

    Links may repeat, run either way, or lead from a node to itself (such are ignored, as are
    links with a null end). Nodes are longs. No links give no rows.
    """
    x, y = F.col(a), F.col(b)
    found = edges.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    found = durable(found)
    before, now = None, _state(found)
    while now != before:
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_least, "a")
        small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        found = durable(small.unionByName(small_least.select("a", F.col("m").alias("b"))).distinct())
        before, now = now, _state(found)
    nodes = found.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = found.select(F.col("b").alias("node")).distinct()
    return nodes.unionByName(roots.select("node", F.col("node").alias("component")))
