"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, written


def _mins(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_mins(both), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Of edges from a larger node u to a smaller v."""
    mins = _mins(edges)
    moved = edges.join(mins, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(mins.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b), root the component's
    smallest node. Loops and repeated edges don't matter; no edges: no rows. Each round
    is written to the shared folder, so that a lost executor costs one round at most."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        before, now = now, written(_small_star(_large_star(now)))
        release(before)
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
