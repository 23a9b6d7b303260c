"""Measures: A7 row-wise fill counts and sums, C12 gaps and attainment, exact averages."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from strata.functions.util import as_col


def filled_count(cols: Sequence) -> Column:
    """Number of non-NULL values among ``cols`` (int)."""
    return reduce(add, [F.when(as_col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cols])


def null_count(cols: Sequence) -> Column:
    return reduce(add, [F.when(as_col(c).isNull(), F.lit(1)).otherwise(F.lit(0)) for c in cols])


def coalesced_sum(cols: Sequence, zero: float = 0.0) -> Column:
    """Sum of ``cols`` with NULL counted as ``zero``, left to right."""
    return reduce(add, [F.coalesce(as_col(c), F.lit(zero)) for c in cols])


def any_decrease(cols: Sequence) -> Column:
    """Q21: true when some column is below its predecessor.

    Three-valued: a NULL hides a drop across it, and the result is NULL when
    no comparison is true and some comparison is unknown.
    """
    pairs = [as_col(b) < as_col(a) for a, b in zip(cols, cols[1:])]
    return reduce(lambda x, y: x | y, pairs)


def gap(actual, target, digits: int = 2) -> Column:
    """``round(actual - target, digits)`` (HALF_UP on the decimal form)."""
    return F.round(as_col(actual) - as_col(target), digits)


def reverse_gap(actual, target, digits: int = 2) -> Column:
    """``round(target - actual, digits)``."""
    return F.round(as_col(target) - as_col(actual), digits)


def attained(actual, target) -> Column:
    """``actual >= target``; NULL when either side is NULL."""
    return as_col(actual) >= as_col(target)


def to_cents(col) -> Column:
    """Money with two decimals -> exact integer cents."""
    return F.round(as_col(col) * 100).cast("bigint")


def mean_of_cents(total_cents, n) -> Column:
    """Average of cent amounts, rounded half-up to whole cents, as a double.

    Exact integer arithmetic (``div`` is integral division), so the result does
    not depend on the order in which partial sums were combined — a double
    average does.  Pass ``total_cents`` as ``decimal(38,0)`` when totals can
    approach the bigint range.  Ties round up; amounts are taken as non-negative.
    """
    s, c = as_col(total_cents), as_col(n)
    cents = F.call_function("div", F.lit(2) * s + c, F.lit(2) * c)
    return F.when(c > 0, cents / F.lit(100.0))
