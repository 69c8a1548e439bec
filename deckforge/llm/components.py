"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum and a join; its edges are written to the shared folder, so a lost
executor repeats one step at most and plans stay short. No component is ever gathered: a node
with very many edges is pre-aggregated on the map side and its join is split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: long columns ``u``, ``v`` (in any order, loops allowed). Returns ``u`` and ``v``: each
    node that isn't the smallest of its component, and that smallest node. No edges: no rows."""
    now = materialize(edges.where(F.col("u") != F.col("v"))
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _signature(now)
    while before[0]:
        now = materialize(_small_star(_large_star(now)), "edges")
        after = _signature(now)
        if after == before:
            break
        before = after
    return now
