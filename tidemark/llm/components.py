"""Connected components by alternating large-star / small-star steps, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    turned = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", most_steps: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link to another.

    ``links`` may hold repeated, mirrored, looping and null pairs.  Every step is a join on a
    node and an aggregate with partial sums, so the centre of a star with any number of leaves
    is never gathered in one task.  Each step is written to the shared folder.
    """
    kind = links.schema[a].dataType
    edges = links.select(F.greatest(a, b).cast(kind).alias("u"), F.least(a, b).cast(kind).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges, before = saved(edges, "links"), None
    for _ in range(most_steps):
        edges = saved(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(2**40))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {most_steps} steps")
