"""Connected components by alternating large and small stars.

Each round hangs every node's neighbours on the smallest of them; the number of rounds
grows with the logarithm of a component's size. Rounds are group-bys and joins that end in
the shared folder; no node's neighbours are ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _with_least(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with the least v of each u.

    The second key repeats the first, so that both sides are shuffled for the join and Spark
    can split a node with very many neighbours.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.min("u").alias("again"))
    least = least.select(F.col("u").alias("of"), "m", "again")
    return pairs.join(least, (F.col("u") == F.col("of")) & (F.col("u") == F.col("again")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from a node to a smaller one."""
    found = _with_least(edges)
    down = found.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return down.unionByName(found.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node that is not itself the smallest.

    ``edges`` has two columns of the same ordered type; the result has ``node`` and ``root``.
    """
    a, b = (F.col(c) for c in edges.columns)
    state = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        figures = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if figures == before or not figures[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = figures
        state = stored(_small_star(_large_star(state)), "edges")
