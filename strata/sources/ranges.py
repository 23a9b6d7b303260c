"""Synthetic ranges generated on the executors."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def year_range(spark: SparkSession, first: int, last: int, name: str = "ano") -> DataFrame:
    """Years ``first..last`` inclusive as an int column."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(name))


def years_between(bounds: DataFrame, first: Column, last: Column, name: str = "ano") -> DataFrame:
    """Years from bounds computed by Spark (one row in ``bounds``), no driver round trip."""
    exploded = bounds.select(F.explode(F.sequence(first, last)).alias(name), "*")
    return exploded.withColumn(name, F.col(name).cast("int"))
