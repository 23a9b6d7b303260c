"""Operator 8: quality rules with robust multivariate outliers, in DataFrame functions only.

``statistics`` counts words, characters, symbols, repeated lines and words in
repeated 8-word windows of every whole text; ``judge`` adds the verdict.  A
text fails the base rules with fewer than 20 words or more than 30 % of its
words in repeated windows.  The others are judged by a minimum covariance
determinant estimate for each language and source:

* the statistics become a vector of four: mean word length, and the square
  roots of symbols, repeated lines and repeated words per word, each drawn
  towards the group's mean (or zero) by ``PRIOR_WORDS`` words, so that short
  texts do not stand out by chance;
* three starts: the coordinate-wise median and quartile spread, mean and
  covariance of all rows, and those of the rows within ``CENTRAL`` spreads of the
  median; each C-step takes the ``COVERAGE`` share of rows nearest by Mahalanobis
  distance and estimates location and covariance anew from them, until the
  determinant falls no more; the start that ends with the least determinant counts;
* scales have the floors ``FLOORS`` (a statistic that is zero in most texts
  has no spread of its own), small enough that each statistic can reject alone;
  a row is an outlier above ``CUTOFF``, the chi-square quantile of ``USUAL``.

Medians and the nearest share come from counts per fine bin, so a group with a
third of all rows is summed map-side and never gathered.  The only collections
are per text.  Sources with fewer than ``MIN_ROWS`` passing rows are judged by the
estimate of all rows of their language, and of languages with fewer by that of
all rows; only a table with fewer in all gives no verdict and keeps its texts.

Defined results: null and empty texts have no words and fail; null languages
and sources are groups of their own; repeated rows count as often as they
occur and get equal verdicts; an empty table gives an empty table.  Equality of
windows is that of 64-bit hashes within one text.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strata.llm.common import ROW, WORD, cut, drop_cut, pack, unpack, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
PRIOR_WORDS = 100
FLOORS = (0.1, 0.04, 0.04, 0.04)
COVERAGE = 0.75
CENTRAL = 2.0
FALLS = 1e-6  # a C-step counts if the logarithm of the determinant falls by more
USUAL = 0.9999
MIN_ROWS = 40
P = len(FLOORS)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _chi_square(share: float) -> float:
    """The chi-square quantile for four degrees of freedom, by bisection."""
    low, high = 0.0, 100.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - math.exp(-mid / 2) * (1 + mid / 2) < share else (low, mid)
    return low


CUTOFF = _chi_square(USUAL)


def _coverage_factor() -> float:
    """Makes the covariance of the nearest COVERAGE share consistent for normal data (four dimensions)."""
    low = _chi_square(COVERAGE)
    return COVERAGE / (1 - math.exp(-low / 2) * (1 + low / 2 + low * low / 8))


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus a struct ``__stats`` with the counts of BASE and ``base_failed``; ``df`` has no column of that name."""
    return unpack(_counted(df, text), F.col("__stats"))


def _counted(df: DataFrame, text: str) -> DataFrame:
    """The packed rows of ``df`` (any columns) and the struct ``__stats``."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = pack(df, __text=body)
    out = out.withColumn("__words", words(F.col("__text")))
    out = out.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda line: line.rlike(WORD)))
    out = out.select(
        "*", F.size("__words").cast("long").alias("__n"), F.length(F.array_join("__words", "")).cast("long").alias("__chars"),
        F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long").alias("__symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("__dup"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__h")).drop("__words", "__lines", "__text")
    at = [lambda i, k=k: F.col("__h")[i + k] for k in range(WINDOW)]
    windows = F.when(F.col("__n") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("__h") - WINDOW), lambda i: F.xxhash64(*[a(i) for a in at])))
    out = out.withColumn("__win", F.coalesce(windows, F.array().cast("array<bigint>"))).drop("__h")
    # sorted (hash, position) pairs, only where some window occurs twice
    out = out.withColumn("__sorted", F.when(F.size(F.array_distinct("__win")) < F.size("__win"), F.sort_array(
        F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("__win")
    twice = F.filter("__sorted", lambda w, k: (w["h"] == F.get("__sorted", k - 1)["h"]) | (w["h"] == F.get("__sorted", k + 1)["h"]))
    out = out.withColumn("__at", F.sort_array(F.transform(twice, lambda w: w["i"]))).drop("__sorted")
    covered = F.aggregate(F.sequence(F.lit(1), F.size("__at") - 1), F.lit(WINDOW).cast("long"),
                          lambda n, k: n + F.least(F.lit(WINDOW), F.get("__at", k) - F.get("__at", k - 1)).cast("long"))
    out = out.withColumn("__repeat", F.coalesce(F.when(F.size("__at") > 1, covered), F.lit(0).cast("long"))).drop("__at")
    failed = (F.col("__n") < MIN_WORDS) | (100 * F.col("__repeat") > MAX_REPEAT_PERCENT * F.col("__n"))
    return out.select(ROW, F.struct(
        *[F.col(c).alias(n) for c, n in zip(("__n", "__chars", "__symbols", "__dup", "__repeat"), BASE, strict=True)],
        failed.alias("base_failed")).alias("__stats"))


def _distance(x: list[Column], m: list[Column], chol: dict[tuple[int, int], Column]) -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor."""
    solved: list[Column] = []
    for i in range(P):
        rest = x[i] - m[i]
        for k in range(i):
            rest = rest - chol[i, k] * solved[k]
        solved.append(rest / chol[i, i])
    return sum((s * s for s in solved[1:]), solved[0] * solved[0])


def _cholesky(frame: DataFrame, cov: dict[tuple[int, int], Column]) -> DataFrame:
    """Columns l00, l10, l11, ... of the factor, one level at a time; the floors keep it regular."""
    for i in range(P):
        for j in range(i + 1):
            value = cov[i, j]
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            floor = FLOORS[i] * 0.1  # rounding may take a pivot below zero
            frame = frame.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(floor * floor))) if i == j
                                     else value / F.col(f"l{j}{j}"))
    return frame


def _group_quantiles(rows: DataFrame, keys: list[str], bin_col: str, shares: dict[str, float]) -> DataFrame:
    """For each key the smallest bin that holds at least the given share of its rows."""
    counts = rows.groupBy(*keys, bin_col).agg(F.count(F.lit(1)).alias("__c"))
    by = Window.partitionBy(*keys)
    counts = counts.withColumn("__cum", F.sum("__c").over(by.orderBy(bin_col))).withColumn("__all", F.sum("__c").over(by))
    return counts.groupBy(*keys).agg(*[
        F.min(F.when(F.col("__cum") >= F.col("__all") * share, F.col(bin_col))).alias(name) for name, share in shares.items()])


ESTIMATE = [*[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i in range(P) for j in range(i + 1)]]


def _estimated(near: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Location and Cholesky factor of the covariance (times ``factor``, with the floors) of the rows of each key."""
    sums = near.groupBy(*keys).agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(P)], *[
        F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"c{i}{j}") for i in range(P) for j in range(i + 1)])
    cov = {(i, j): (F.col(f"c{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * factor + (FLOORS[i] ** 2 if i == j else 0.0)
           for i in range(P) for j in range(i + 1)}
    return _cholesky(sums, cov).select(*keys, *ESTIMATE)


def _groups(spark: SparkSession, passing: DataFrame) -> DataFrame:
    """(__lang, __source, grp, mean_length, grp_rows, judges): the groups that the rows of each source belong to.

    A group is a source, a language or all rows; ``judges`` marks the smallest with MIN_ROWS rows, the one that judges the source.
    """
    totals = cut(spark, passing.groupBy("__lang", "__source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("__stats.word_chars").alias("chars"), F.sum("__stats.n_words").alias("words")), "quality-totals")
    lang, source = [F.col("__lang"), F.col("__lang").isNull()], [F.col("__source"), F.col("__source").isNull()]
    grps = F.array(*[F.struct(F.lit(k).alias("level"), F.xxhash64(F.lit(k), *by).alias("grp")) for k, by in enumerate(([*lang, *source], lang, []))])
    of = totals.select("*", F.explode(grps).alias("g")).select("__lang", "__source", "rows", "chars", "words", "g.*")
    sums = of.groupBy("grp").agg((F.sum("chars") / F.sum("words")).alias("mean_length"), F.sum("rows").alias("grp_rows"))
    of = of.join(sums, "grp")
    enough = F.min(F.when((F.col("grp_rows") >= MIN_ROWS) | (F.col("level") == 2), F.col("level"))).over(Window.partitionBy("__lang", "__source"))
    of = of.withColumn("judges", F.col("level") == enough)
    needed = of.filter("judges").select("grp").distinct()
    return cut(spark, of.join(needed, "grp").select("__lang", "__source", "grp", "mean_length", "grp_rows", "judges"), "quality-groups")


def fit(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Estimates per group from (__lang, __source, __stats): one row per source with location and factor of the group that judges it.

    ``rows`` is read several times and should be a written table.
    """
    passing = rows.filter(~F.col("__stats.base_failed"))
    groups = _groups(spark, passing)
    seen = vectors(passing, groups).filter(F.col("grp_rows") >= MIN_ROWS).select("grp", *[f"x{i}" for i in range(P)])
    seen = cut(spark, seen, "quality-vectors")
    # medians and quartile spreads, from counts per bin of a quarter floor
    long = seen.select("grp", F.posexplode(F.array(*[F.floor(F.col(f"x{i}") / (FLOORS[i] / 4)) for i in range(P)])).alias("dim", "bin"))
    q = _group_quantiles(long, ["grp", "dim"], "bin", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    floors = F.element_at(F.array(*[F.lit(f) for f in FLOORS]), F.col("dim") + 1)
    start = q.select("grp", "dim", ((F.col("q2") + 0.5) * floors / 4).alias("m"),
                     F.sqrt(F.pow((F.col("q3") - F.col("q1")) * floors / 4 / 1.349, 2) + floors * floors).alias("s"))
    params = start.groupBy("grp").agg(*[F.max(F.when(F.col("dim") == i, F.col("m"))).alias(f"m{i}") for i in range(P)],
                                      *[F.max(F.when(F.col("dim") == i, F.col("s"))).alias(f"l{i}{i}") for i in range(P)])
    medians = cut(spark, params.select("grp", *[f"m{i}" for i in range(P)], *[
        (F.col(f"l{i}{i}") if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(P) for j in range(i + 1)]), "quality-medians")
    central = seen.join(medians, "grp")
    for i in range(P):
        central = central.filter(F.abs(F.col(f"x{i}") - F.col(f"m{i}")) <= CENTRAL * F.col(f"l{i}{i}"))
    starts = [medians, _estimated(seen, ["grp"], 1.0), _estimated(central.select(seen.columns), ["grp"], 1.0)]
    starts = [x.select("grp", F.lit(k).alias("start"), *ESTIMATE, F.lit(math.inf).alias("size"), F.lit(True).alias("falls")) for k, x in enumerate(starts)]
    done = cut(spark, starts[0].union(starts[1]).union(starts[2]), "quality-start")
    factor, keys = _coverage_factor(), ["grp", "start"]
    size = sum((2 * F.log(f"l{i}{i}") for i in range(1, P)), 2 * F.log("l00"))  # logarithm of the determinant
    while done.filter("falls").limit(1).count():
        measured = seen.join(done.filter("falls"), "grp").select(*keys, *[f"x{i}" for i in range(P)], F.floor(F.log1p(distance()) * 64).alias("bin"))
        edge = cut(spark, _group_quantiles(measured, keys, "bin", {"edge": COVERAGE}), "quality-edge")
        near = measured.join(edge, keys).filter(F.col("bin") <= F.col("edge"))
        after = _estimated(near, keys, factor).withColumn("size", size).select(*keys, F.struct(*ESTIMATE, "size").alias("after"))
        falls = F.coalesce(F.col("after.size") < F.col("size") - FALLS, F.lit(False))
        both = done.join(after, keys, "left").withColumn("falls", falls)
        previous, done = done, cut(spark, both.select(*keys, *[
            F.when(F.col("falls"), F.col(f"after.{c}")).otherwise(F.col(c)).alias(c) for c in (*ESTIMATE, "size")], "falls"), "quality-step")
        drop_cut(spark, previous, edge)
    best = done.groupBy("grp").agg(F.min(F.struct("size", "start", *ESTIMATE)).alias("b")).select("grp", *[f"b.{c}" for c in ESTIMATE])
    return groups.filter("judges").join(best, "grp", "left").drop("judges")


def vectors(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with its group and the transformed vector x0..x3; rows whose group has no passing text keep nulls."""
    joined = rows.alias("r").join(groups.alias("g"), F.col("r.__lang").eqNullSafe(F.col("g.__lang"))
                                  & F.col("r.__source").eqNullSafe(F.col("g.__source")), "left")
    n = F.col("__stats.n_words") + PRIOR_WORDS
    return joined.select("r.*", *[F.col(f"g.{c}") for c in groups.columns if c not in ("__lang", "__source")],
                         ((F.col("__stats.word_chars") + PRIOR_WORDS * F.col("g.mean_length")) / n).alias("x0"),
                         F.sqrt(F.col("__stats.n_symbols") / n).alias("x1"), F.sqrt(F.col("__stats.n_dup_lines") / n).alias("x2"),
                         F.sqrt(F.col("__stats.n_repeat_words") / n).alias("x3"))


def distance() -> Column:
    return _distance([F.col(f"x{i}") for i in range(P)], [F.col(f"m{i}") for i in range(P)],
                     {(i, j): F.col(f"l{i}{j}") for i in range(P) for j in range(i + 1)})


def judge_rows(spark: SparkSession, df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Each row of ``df`` (columns of any names) packed in ``__row``, and a struct ``__quality``: the counts of BASE,
    base_failed, distance (null: no verdict) and kept."""
    table = cut(spark, _counted(df, text).select(
        ROW, F.col(f"{ROW}.`{lang}`").alias("__lang"), F.col(f"{ROW}.`{source}`").alias("__source"), "__stats"), "quality-statistics")
    params = cut(spark, fit(spark, table.drop(ROW)), "quality-estimates")
    scored = vectors(table, params).withColumn("__d", distance())
    verdict = F.struct("__stats.*", F.col("__d").alias("distance"),
                       (~F.col("__stats.base_failed") & (F.coalesce(F.col("__d"), F.lit(0.0)) <= CUTOFF)).alias("kept"))
    return scored.select(ROW, verdict.alias("__quality"))


def judge(spark: SparkSession, df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``df`` plus the struct ``__quality`` of ``judge_rows``; ``df`` has no column of that name."""
    return unpack(judge_rows(spark, df, text, lang, source), F.col("__quality"))
