"""Connected components of a distributed edge list by alternating large and small stars.

Every round rewrites the edges so that each node points at the smallest node it has seen;
the rounds needed grow with the logarithm of the longest chain. Edges stay distributed and
each round is written to the shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return (moved.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is its smallest node.

    Null ends and self links are ignored; an empty list gives an empty result.
    """
    edges = materialize(links.where("a is not null and b is not null and a != b")
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                        "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = materialize(_small_star(_large_star(edges)), "edges")
        # converged when the edge list no longer changes: count and two checksums
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
