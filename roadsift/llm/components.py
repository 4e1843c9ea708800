"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsift.llm.common import cut, forget

MOST_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m) for (u, v) rows: m is the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).select((F.bitwise_not(F.col("u"))).alias("w"), "m")
    return edges.withColumn("w", F.bitwise_not(F.col("u"))).join(least, "w").select("u", "v", "m")  # dealt anew, so that a hub can be split


def _round(now: DataFrame) -> DataFrame:
    both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    small = _least(large)
    pulled = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pulled.union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); the component is its least node.

    Each round points larger neighbours and then smaller ones at the least one nearby, which ends
    in stars after a few rounds. Links go through the shared checkpoint folder between rounds.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    for _ in range(MOST_ROUNDS):
        told = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if told == before:
            break
        before = told
        done, now = now, cut(_round(now))
        forget(done)
    else:
        raise RuntimeError("components didn't settle")
    out = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return out.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
