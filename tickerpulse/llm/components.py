"""Connected components of an edge table, by alternating large and small stars.

Every step is an aggregate (a minimum per node, combined map-side) and a
plain equi-join of two stored tables, so a star centre with very many
neighbours is split by adaptive execution like any other skewed key.
Nothing is collected but one row of sums per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _signature(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _with_min(both: DataFrame) -> DataFrame:
    """Each (u, v) with m, the smallest node among u and all its neighbours."""
    low = stored(both.groupBy("u").agg(F.min("v").alias("low"))
                 .select(F.col("u").alias("node"), F.least("u", "low").alias("m")), "cc-min")
    return both.join(low, both["u"] == low["node"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = (edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e"))
        .select("e.u", "e.v"))
    return (_with_min(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    return (_with_min(down)
            .select(F.explode(F.array("v", "u")).alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node it reaches.

    ``edges`` has two columns of one orderable type; direction, repeats and
    loops do not matter, rows with a NULL end are ignored. Rounds grow with
    the logarithm of the longest path; ``max_rounds`` only guards against an
    endless loop and raises when it is hit. An empty table gives an empty one.
    """
    a, b = edges.columns[:2]
    cur = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                 .filter("a <> b").distinct(), "cc-edges")
    seen = _signature(cur)
    for _ in range(max_rounds):
        large = stored(_large_star(cur), "cc-large")
        cur = stored(_small_star(large), "cc-small")
        now = _signature(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
