"""R1 unpivot, U1-U3 unions and universes, U4 table reconciliation."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


COPY_BLOCK = 100_000     # copies of a row that one array holds


def unpivot_columns(df: DataFrame, ids: Sequence[str | Column], columns: Mapping, name_col: str,
                    value_col: str, value_type: str | None = None, drop_nulls: bool = True) -> DataFrame:
    """Wide -> long.  ``columns`` maps the tag to emit (e.g. a year) to a column.

    Runs as a generator in the same stage as the scan (no shuffle); NULL values
    are dropped unless ``drop_nulls`` is False.
    """
    cells = []
    for tag, col in columns.items():
        v = F.col(col) if isinstance(col, str) else col
        if value_type:
            v = v.cast(value_type)
        cells.append(F.struct(F.lit(tag).alias(name_col), v.alias(value_col)))
    out = df.select(*ids, F.inline(F.array(*cells)))
    return out.filter(F.col(value_col).isNotNull()) if drop_nulls else out


def key_universe(columns: Sequence[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Distinct values of one key over several tables (positional union).

    Each input is projected to its key first, so only the key is shuffled, and
    the distinct runs with map-side partial aggregation.
    """
    parts = [df.select(F.col(c).alias(name)) for df, c in columns]
    return reduce(DataFrame.union, parts).distinct()


def pair_universe(frames: Sequence[DataFrame], columns: Sequence[str], not_null: str | None = None) -> DataFrame:
    """Distinct tuples over several tables; rows with a NULL ``not_null`` removed.

    The filter commutes with union + distinct, so Catalyst applies it before
    the shuffle.
    """
    parts = [df.select(*columns) for df in frames]
    out = reduce(DataFrame.union, parts).distinct()
    return out.filter(F.col(not_null).isNotNull()) if not_null else out


def stack_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def _side_counts(a: DataFrame, b: DataFrame) -> tuple[DataFrame, list[str]]:
    """Every distinct row of ``a`` ∪ ``b`` with its multiplicity on each side.

    One union and one aggregation on all columns: partial sums run map-side,
    so a row repeated millions of times is shuffled once per map task — no
    join, hence no join task holding every copy of a hot row.  NULLs compare
    equal and NaN is normalised, exactly as in EXCEPT.
    """
    cols = a.columns
    b = b.select(*cols)
    tagged = (a.select(*cols, F.lit(1).alias("__in_a"), F.lit(0).alias("__in_b"))
               .unionByName(b.select(*cols, F.lit(0).alias("__in_a"), F.lit(1).alias("__in_b"))))
    counts = tagged.groupBy(*cols).agg(F.sum("__in_a").alias("__n_a"), F.sum("__in_b").alias("__n_b"))
    return counts, cols


def reconcile(a: DataFrame, b: DataFrame, side_col: str = "side", keep_duplicates: bool = False) -> DataFrame:
    """U4: rows only in ``a`` and rows only in ``b`` (columns matched by name).

    ``keep_duplicates=False`` is ``EXCEPT DISTINCT`` both ways; True is
    ``EXCEPT ALL`` (``max(n_a - n_b, 0)`` copies of a row as ``only_in_a``, and
    the converse).  Both directions come out of the same single aggregation.
    """
    counts, cols = _side_counts(a, b)
    n_a, n_b = F.col("__n_a"), F.col("__n_b")
    side = F.when(n_a > n_b, F.lit("only_in_a")).otherwise(F.lit("only_in_b")).alias(side_col)
    if not keep_duplicates:
        return counts.filter((n_a > 0) != (n_b > 0)).select(side, *cols)
    diff = counts.filter(n_a != n_b)
    # copies in two steps of bounded arrays, dealt out in between, so that a row with very many copies is no single task
    blocks = diff.select(side, *cols, F.abs(n_a - n_b).alias("__n")).select("*", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__n") - 1) / COPY_BLOCK))).alias("__block"))
    inside = F.least(F.lit(COPY_BLOCK), F.col("__n") - F.col("__block") * COPY_BLOCK).cast("int")
    return blocks.repartition("__block", *cols).select(side_col, *cols, F.explode(F.array_repeat(F.lit(1), inside)).alias("__copy")).drop("__copy")


def schema_diff(a: DataFrame, b: DataFrame) -> dict:
    """U4: column names / types present on one side only (metadata, no job)."""
    fa = {f.name: f.dataType.simpleString() for f in a.schema.fields}
    fb = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    return {
        "only_in_a": sorted(set(fa) - set(fb)),
        "only_in_b": sorted(set(fb) - set(fa)),
        "type_changed": sorted(c for c in set(fa) & set(fb) if fa[c] != fb[c]),
    }


def reconcile_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4 counts in long form ``(metric, value)``: rows per side and distinct rows
    only on each side — all four from the one aggregation behind ``reconcile``."""
    counts, _ = _side_counts(a, b)
    n_a, n_b = F.col("__n_a"), F.col("__n_b")
    totals = counts.agg(
        F.coalesce(F.sum(n_a), F.lit(0)).cast("bigint").alias("rows_a"),
        F.coalesce(F.sum(n_b), F.lit(0)).cast("bigint").alias("rows_b"),
        F.count_if((n_a > 0) & (n_b == 0)).alias("only_in_a"),
        F.count_if((n_b > 0) & (n_a == 0)).alias("only_in_b"),
    )
    metrics = ["rows_a", "rows_b", "only_in_a", "only_in_b"]
    return totals.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                            for m in metrics])))


def compare_tables(a: DataFrame, b: DataFrame) -> dict:
    """U4 as one call: schema differences (metadata only), then counts and the
    differing rows over the columns both sides share (both lazy DataFrames)."""
    common = [c for c in a.columns if c in set(b.columns)]
    a2, b2 = a.select(*common), b.select(*common)
    return {"schema": schema_diff(a, b), "counts": reconcile_summary(a2, b2), "rows": reconcile(a2, b2)}


def targets_by_year(latest: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """One row per ``keys`` with a map year -> value; ``latest`` has one row per key and year, so the map is as long as the horizon."""
    entries = F.collect_list(F.struct(F.col(year), F.col(value)))
    return latest.filter(F.col(year).isNotNull()).groupBy(*keys).agg(F.map_from_entries(entries).alias("targets"))
