"""Registry of catalogue queries: ``name -> (spark_fn, oracle_sql | None)``.

Every query reads the driver's tables under ``sf_dir`` (``<sf_dir>/<t>.parquet``)
in full and returns a lazy DataFrame.  The oracle is hand-written DuckDB SQL over
views of the same tables, aliased to the same column names.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco
