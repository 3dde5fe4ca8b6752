"""Connected components of an edge table, by repeated star contraction in Spark.

Alternates two local rewrites of the edge set: every vertex links its larger
neighbours to its smallest one, then its smaller neighbours likewise.  Both
keep the components; the edge set ends as one star per component.  A vertex
with very many neighbours costs no more than its edges: neighbour minima are
pre-aggregated and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spillway.llm.common import Workspace

MAX_ROUNDS = 60  # safety stop, far above log2 of any graph's size; reaching it raises


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_minimum(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    mins = _minimum(down)
    rest = down.join(mins, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(mins.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every vertex is a leaf with one edge or a centre, never both: then centres are the smallest ids."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    mixed = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).where("leaf + centre > 1")
    return mixed.isEmpty()


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(id, component) of every vertex that has an edge; component: the smallest id it reaches.

    `edges` has two long columns, taken as undirected; self-loops and repeats are allowed.
    """
    a, b = edges.columns[:2]
    now = work.write(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), f"{name}-0")
    for i in range(1, MAX_ROUNDS):
        now = work.write(_small_star(_large_star(now)), f"{name}-{i}")
        if _stars(now):
            leaves = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return leaves.union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
    raise RuntimeError("connected components did not converge")
