"""Keep exactly one row per key, deterministically.

Both are ``row_number() = 1`` over a window.  Spark plans this as a partial
``WindowGroupLimit`` *before* the shuffle and a final one after it, so a hot key
(say a third of all rows) reaches the reducer as at most one row per map
partition — the hot group is never sorted or buffered in a single task.

The original recipes keep an arbitrary row (``dropDuplicates``) or order by one
column only; here the order is always completed to a total order so that the
same input gives the same survivors on every run.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType

RANK = "__rank"


def total_order(df: DataFrame, keys: Sequence[str], first: Sequence[Column] = ()) -> list[Column]:
    """``first`` followed by every other orderable column ascending (NULLs last, so a filled row is preferred)."""
    used = set(keys)
    rest = [F.col(f.name).asc_nulls_last() for f in df.schema.fields
            if f.name not in used and not isinstance(f.dataType, MapType)]
    return [*first, *rest]


def keep_one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
                     complete_order: bool = True) -> DataFrame:
    """One row per ``keys``; the first row under ``order``.

    ``order`` defaults to all non-key columns ascending.  With
    ``complete_order`` the given order is extended by the remaining columns so
    ties are broken the same way every run.  NULL keys form one group, as in
    ``dropDuplicates``.
    """
    order = list(order or [])
    if complete_order or not order:
        order = total_order(df, keys, order)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(w)).filter(F.col(RANK) == 1).drop(RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str | Column,
                   tiebreak: Sequence[Column] = (), complete_order: bool = True) -> DataFrame:
    """The row with the greatest ``by`` per key (NULL ``by`` loses)."""
    by_col = F.col(by) if isinstance(by, str) else by
    return keep_one_per_key(df, keys, [by_col.desc_nulls_last(), *tiebreak], complete_order)
