from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(col) -> Column:
    """Accept a column name or a Column."""
    return F.col(col) if isinstance(col, str) else col
