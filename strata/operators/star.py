"""Dimension enrichment and key integrity.

Dimension joins carry no hint: the planner broadcasts a side below its byte
threshold, adaptive execution does so once it knows the real size, and any
other side goes through a shuffle join whose skewed partitions it splits.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

def enrich(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """``fact`` joined to ``dim`` on shared column names (USING)."""
    return fact.join(dim, on=on, how=how)


def distinct_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct rows of a projection (partial aggregation before the shuffle)."""
    return df.select(*columns).distinct()


def orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
            parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose key has no parent row (NOT EXISTS)."""
    parent_keys = list(parent_keys or child_keys)
    p = parent.select(*[F.col(pk).alias(f"__p{i}") for i, pk in enumerate(parent_keys)]).distinct()
    cond = [F.col(ck) == F.col(f"__p{i}") for i, ck in enumerate(child_keys)]
    return child.join(p, cond, "left_anti")


def orphan_summary(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                   parent_keys: Sequence[str] | None = None) -> DataFrame:
    """J6 as one row: orphan rows and distinct orphan keys.

    No join: child and parent keys are tagged, stacked and counted per key in
    one aggregation (map-side partial sums, so a key holding a third of the
    child rows is shuffled once per map task).  Parent rows with a NULL key are
    left out — NULL never equals anything — so child rows with a NULL key are
    orphans, as with NOT EXISTS.
    """
    parent_keys = list(parent_keys or child_keys)
    names = [f"__k{i}" for i in range(len(child_keys))]
    c = child.select(*[F.col(k).alias(n) for k, n in zip(child_keys, names)],
                     F.lit(1).alias("__child"), F.lit(0).alias("__parent"))
    p = parent.select(*[F.col(k).alias(n) for k, n in zip(parent_keys, names)],
                      F.lit(0).alias("__child"), F.lit(1).alias("__parent"))
    for n in names:
        p = p.filter(F.col(n).isNotNull())
    per_key = c.unionByName(p).groupBy(*names).agg(F.sum("__child").alias("__nc"), F.sum("__parent").alias("__np"))
    orphan = (F.col("__nc") > 0) & (F.col("__np") == 0)
    return per_key.agg(
        F.coalesce(F.sum(F.when(orphan, F.col("__nc"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
    )
