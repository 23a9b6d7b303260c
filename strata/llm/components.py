"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a minimum per node (summed map-side, so a node with any share of
the edges is no hot spot) and one join that adaptive execution can split.  Each
step is cut off in the shared folder; only a count and a checksum reach the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import cut, drop_cut


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node that links reach."""
    own = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = cut(spark, own, "components")
    seen = _fingerprint(now)
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()  # one shuffle, read by both sides below
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        after = cut(spark, small.filter("a != b").distinct(), "components")
        drop_cut(spark, now)
        now, before, seen = after, seen, _fingerprint(after)
        if seen == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
