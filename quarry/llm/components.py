"""Connected components by alternating stars, as DataFrame joins.

Every round points each node's larger neighbours (large star) and then its
smaller neighbours (small star) at the smallest neighbour, until no edge
changes; the rounds needed grow with the logarithm of the longest path. Edges
stay distributed and each round is written to the shared folder. A hub's rows
are in a join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``, except that a
    component's smallest node is left out: it is its own component."""
    cur = materialise(edges.where("a <> b")
                      .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "edges")
    state = _state(cur)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        cur = materialise(_small_star(_large_star(cur)), "stars")
        now = _state(cur)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    onto = e.join(low, "u")
    return (onto.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(low.select("u", F.col("m").alias("v"))).distinct())
