"""Decoding: C4 code -> label, C5 0/1 flags, C6 label normaliser, C10 periods."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.casts import safe_cast
from strata.functions.domains import (
    LAST_OBSERVED_YEAR,
    NETWORK_LABELS,
    PUBLIC_LABEL,
    PUBLIC_LABEL_VARIANTS,
)
from strata.functions.util import as_col


def literal_map(mapping: Mapping) -> Column:
    """A literal ``map<k, v>`` column (constant-folded by Catalyst)."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def decode(col, mapping: Mapping = NETWORK_LABELS) -> Column:
    """C4: look ``col`` up in a small literal map; unknown or NULL -> NULL.

    ``map[key]`` on a missing key is NULL even with ANSI on.  For a mapping of
    more than a few hundred entries use ``decode_join`` instead.
    """
    return literal_map(mapping)[as_col(col)]


def decode_join(df: DataFrame, code_col: str, lookup: DataFrame, lookup_code: str,
                lookup_label: str, label_col: str) -> DataFrame:
    """C4 for large code lists: left join to a lookup table.

    The lookup is reduced to one label per code first (the smallest, so a
    duplicated code gives the same answer every run), so the join can never
    multiply fact rows.
    """
    table = (lookup.groupBy(F.col(lookup_code).alias("__code"))
                   .agg(F.min(lookup_label).alias(label_col)))
    return df.join(table, F.col(code_col) == F.col("__code"), "left").drop("__code")


def flag_to_bool(col) -> Column:
    """1 -> true, 0 -> false, anything else (incl. NULL) -> NULL boolean."""
    c = as_col(col)
    return F.when(c.isin(0, 1), c == 1)


def decode_flags(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """C5 on a DataFrame: each flag ``x`` becomes ``x_id`` (int) and ``x`` (boolean).

    ``x_id`` takes the position of ``x``; ``x`` is appended at the end, as a
    rename followed by a new column would do.
    """
    ids = {f: safe_cast(df, f, "int") for f in flags}
    out = df.select(*[ids[c].alias(f"{c}_id") if c in ids else F.col(c) for c in df.columns])
    return out.withColumns({f: flag_to_bool(F.col(f"{f}_id")) for f in flags})


def normalize_label(col, variants: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Trim, lower; known spellings -> canonical label; '' -> NULL; else title case.

    ``variants`` maps each canonical label to its lower-case spellings (broken
    encodings included).  Title case is Spark's ``initcap``: the first letter of
    each space-separated word upper-cased, the rest lower-cased, so
    ``'pública (estadual e municipal)'`` becomes ``'Pública (estadual E Municipal)'``.
    """
    if variants is None:
        variants = {PUBLIC_LABEL: PUBLIC_LABEL_VARIANTS}
    clean = F.trim(as_col(col).cast("string"))
    lowered = F.lower(clean)
    expr = None
    for canonical, spellings in variants.items():
        cond = lowered.isin(*spellings)
        expr = F.when(cond, F.lit(canonical)) if expr is None else expr.when(cond, F.lit(canonical))
    empty = clean == ""
    expr = F.when(empty, F.lit(None)) if expr is None else expr.when(empty, F.lit(None))
    return expr.otherwise(F.initcap(lowered))


def classify_period(year_col, last_observed=LAST_OBSERVED_YEAR) -> Column:
    """``'realizado'`` up to ``last_observed`` (an int or a Column), ``'projetado'`` after."""
    y = as_col(year_col)
    bound = last_observed if isinstance(last_observed, Column) else F.lit(last_observed)
    return F.when(y <= bound, F.lit("realizado")).otherwise(F.lit("projetado"))
