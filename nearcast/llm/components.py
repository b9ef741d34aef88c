"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is an aggregation (partial minima per task) and a join; what a step
returns is a table in the shared folder, and the driver sees one count and one
checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearcast.session import materialize


def connected_components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (a, b: long, not null)."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        if are_stars(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        # large star: larger neighbours point to the smallest of the neighbourhood
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: the smaller neighbours of a node and the node point to the smallest of them
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError(f"components not stable after {rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def are_stars(edges: DataFrame) -> bool:
    """Whether every node either points to one node that points nowhere, or points nowhere."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    each = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return each.agg(F.count(F.when((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1)), 1))).first()[0] == 0
