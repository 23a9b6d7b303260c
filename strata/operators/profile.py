"""Q25 value-frequency profile, O1-O3 ordering and previews."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def value_profile(df: DataFrame, columns: Sequence[str], count_col: str = "n") -> DataFrame:
    """Q25: frequency of every value of every listed column, in one job.

    Columns are stacked as text (column_name, value) by a generator in the
    scan stage, then counted with map-side partial aggregation.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.inline(cells))
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias(count_col)))


def by_frequency(df: DataFrame, count_col: str = "n", keys: Sequence[str] = ()) -> DataFrame:
    """O1: most frequent first, then keys ascending with NULLs first."""
    return df.orderBy(F.col(count_col).desc(), *[F.col(k).asc_nulls_first() for k in keys])


def preview(df: DataFrame, n: int = 100, order: Sequence = ()) -> DataFrame:
    """O3: a bounded preview (top-n under ``order`` — a TakeOrderedAndProject)."""
    return (df.orderBy(*order) if order else df).limit(n)
