"""Catalogue: reshape, star joins and latest-per-key on the driver tables.

The gold layer of the literacy model (indicator fact, network dimension,
wide yearly targets at three geographic levels, latest target per key, gaps)
is rebuilt on TPC-H shapes:

* place  = nation (level ``nation``), region (level ``region``), everything (``world``)
* network code / label = order-priority code (``'1'``) / label (``'1-URGENT'``);
  world-level targets carry the label ``'ALL PRIORITIES'``, which matches no
  dimension label, like the generic "public" label of the original targets
* reference year = order year; indicator = average order value (exact cents)
* targets for year y set in reference year r < y: ``base_r + 1000 * (y - r)``
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.functions import (
    any_decrease, attained, classify_period, decode, gap, mean_of_cents, reverse_gap, to_cents,
)
from strata.operators.dedup import latest_per_key
from strata.operators.reshape import key_universe as _key_universe
from strata.operators.reshape import pair_universe, reconcile, reconcile_summary, unpivot_columns
from strata.operators.star import distinct_projection, enrich, orphan_summary
from strata.plans.catalog.cleaning import STATUS_LABELS
from strata.plans.catalog.registry import register
from strata.session import shared_path
from strata.sources import TableSet, files, read_table, write_table, years_between

# --- Fixed values: horizon of the wide target layout ---------------------------
YEARS = list(range(1995, 2002))       # seven target years, like 2024..2030
FINAL_YEAR = 2001
ALL_LABEL = "ALL PRIORITIES"
TARGET_STEP = 1000.0
EXACT = "decimal(38,0)"    # cent totals stay exact (no bigint overflow) at any scale


def order_facts(t: TableSet) -> DataFrame:
    """(o_custkey, ref_year, priority_label, cents, n, nationkey, regionkey).

    Orders are summed per (customer, year, priority) *before* the join to
    customer (map-side partial aggregation first, so even a customer holding a
    third of all orders reaches the join as a handful of rows).
    """
    per_cust = (t.orders
                .select("o_custkey", F.year("o_orderdate").alias("ref_year"),
                        F.col("o_orderpriority").alias("priority_label"), to_cents("o_totalprice").alias("cents"))
                .groupBy("o_custkey", "ref_year", "priority_label")
                .agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n")))
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nationkey"))
    nation = t.nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_regionkey").alias("regionkey"))
    return per_cust.join(cust, "o_custkey").join(nation, "nationkey", "left")


def level_totals(t: TableSet) -> DataFrame:
    """Cent totals and order counts of all three levels in ONE aggregation.

    ``groupingSets`` expands each fact row once per level inside the map stage
    and aggregates all levels with a single shuffle:
    (level, place_id, priority_label, ref_year, s, c).
    """
    g = order_facts(t).groupingSets(
        [["ref_year"], ["ref_year", "regionkey", "priority_label"], ["ref_year", "nationkey", "priority_label"]],
        "ref_year", "regionkey", "nationkey", "priority_label",
    ).agg(F.sum(F.col("cents").cast(EXACT)).alias("s"), F.sum("n").alias("c"),
          F.grouping("regionkey").alias("g_region"), F.grouping("nationkey").alias("g_nation"))
    world = (F.col("g_region") == 1) & (F.col("g_nation") == 1)
    region = F.col("g_nation") == 1
    return g.select(
        F.when(world, F.lit("world")).when(region, F.lit("region")).otherwise(F.lit("nation")).alias("level"),
        F.when(world, F.lit(None).cast("string")).when(region, F.col("regionkey").cast("string"))
         .otherwise(F.col("nationkey").cast("string")).alias("place_id"),
        F.when(world, F.lit(ALL_LABEL)).otherwise(F.col("priority_label")).alias("priority_label"),
        "ref_year", "s", "c",
    )


def wide_targets(totals: DataFrame) -> DataFrame:
    """Wide targets of all levels: ``target_1995 .. target_2001`` (NULL when y <= ref_year)."""
    base = totals.select("level", "place_id", "priority_label", "ref_year", mean_of_cents("s", "c").alias("base"))
    return base.select(
        "level", "place_id", "priority_label", "ref_year",
        *[F.when(F.lit(y) > F.col("ref_year"),
                 F.col("base") + F.lit(TARGET_STEP) * (F.lit(y) - F.col("ref_year"))).alias(f"target_{y}")
          for y in YEARS])


def long_targets(totals: DataFrame) -> DataFrame:
    """One generator makes the level and year cells from one aggregate, so the facts are joined and summed once."""
    ids = ["level", "place_id", "priority_label", "ref_year"]
    return unpivot_columns(wide_targets(totals), ids, {y: f"target_{y}" for y in YEARS}, "target_year", "target_value")


def priority_dimension(t: TableSet) -> DataFrame:
    """(priority_code, priority_label) pairs, NULL code removed."""
    o = t.orders.select(F.substring("o_orderpriority", 1, 1).alias("priority_code"),
                        F.col("o_orderpriority").alias("priority_label"))
    return pair_universe([o], ["priority_code", "priority_label"], not_null="priority_code")


def labelled_targets(t: TableSet, totals: DataFrame | None = None) -> DataFrame:
    """Long targets joined to the dimension on the *label*; unmatched kept.

    The dimension is derived (a distinct over orders), so its size is left to
    AQE's runtime check rather than a pre-count, which would cost a full pass.
    """
    totals = totals if totals is not None else level_totals(t)
    return enrich(long_targets(totals), priority_dimension(t), "priority_label", "left")


_FACTS_SQL = """
f AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS ref_year, c.c_nationkey AS nationkey, n.n_regionkey AS regionkey,
         o.o_orderpriority AS priority_label, CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
b AS (
  SELECT 'world' AS level, CAST(NULL AS VARCHAR) AS place_id, 'ALL PRIORITIES' AS priority_label, ref_year,
         sum(cents) AS s, count(*) AS c FROM f GROUP BY ref_year
  UNION ALL
  SELECT 'region', CAST(regionkey AS VARCHAR), priority_label, ref_year, sum(cents), count(*)
  FROM f GROUP BY regionkey, priority_label, ref_year
  UNION ALL
  SELECT 'nation', CAST(nationkey AS VARCHAR), priority_label, ref_year, sum(cents), count(*)
  FROM f GROUP BY nationkey, priority_label, ref_year),
lt AS (
  SELECT level, place_id, priority_label, ref_year, CAST(y AS INTEGER) AS target_year,
         CAST((2 * s + c) // (2 * c) AS DOUBLE) / CAST(100 AS DOUBLE)
           + CAST(1000 AS DOUBLE) * (y - ref_year) AS target_value
  FROM (SELECT *, unnest([1995, 1996, 1997, 1998, 1999, 2000, 2001]) AS y FROM b) yr
  WHERE y > ref_year),
dp AS (
  SELECT DISTINCT substr(o_orderpriority, 1, 1) AS priority_code, o_orderpriority AS priority_label
  FROM orders WHERE substr(o_orderpriority, 1, 1) IS NOT NULL)
"""


@register("unpivot_measures", "WITH " + _FACTS_SQL + """
SELECT level, place_id, priority_label, ref_year, target_year, target_value FROM lt
""")
def unpivot_measures(spark, sf_dir):
    """Wide yearly targets of three levels -> one long table, NULLs dropped."""
    t = TableSet(spark, sf_dir)
    return long_targets(level_totals(t))


@register("label_join", "WITH " + _FACTS_SQL + """
SELECT lt.level, lt.place_id, lt.priority_label, lt.ref_year, lt.target_year, lt.target_value, dp.priority_code
FROM lt LEFT JOIN dp ON lt.priority_label = dp.priority_label
""")
def label_join(spark, sf_dir):
    """Join on the text label; world-level rows keep a NULL code."""
    return labelled_targets(TableSet(spark, sf_dir))


@register("code_label_universe", """
SELECT DISTINCT status_code, status_label FROM (
  SELECT l_linestatus AS status_code,
         CASE l_linestatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Fulfilled' END AS status_label FROM lineitem
  UNION ALL
  SELECT o_orderstatus, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Fulfilled' END FROM orders) t
WHERE status_code IS NOT NULL
""")
def code_label_universe(spark, sf_dir):
    """(code, label) pairs over two tables; codes without a label are kept."""
    t = TableSet(spark, sf_dir)
    a = t.lineitem.select(F.col("l_linestatus").alias("status_code"),
                          decode("l_linestatus", STATUS_LABELS).alias("status_label"))
    b = t.orders.select(F.col("o_orderstatus").alias("status_code"),
                        decode("o_orderstatus", STATUS_LABELS).alias("status_label"))
    return pair_universe([a, b], ["status_code", "status_label"], not_null="status_code")


@register("key_universe", """
SELECT c_nationkey AS nationkey FROM customer
UNION SELECT s_nationkey FROM supplier
UNION SELECT n_nationkey FROM nation
""")
def key_universe(spark, sf_dir):
    """U1 + A8: distinct keys over three tables (positional union)."""
    t = TableSet(spark, sf_dir)
    return _key_universe([(t.customer, "c_nationkey"), (t.supplier, "s_nationkey"), (t.nation, "n_nationkey")],
                         "nationkey")


@register("dim_enrich", """
WITH u AS (SELECT c_nationkey AS nationkey FROM customer
           UNION SELECT CASE s_suppkey % 9 WHEN 0 THEN s_nationkey + 1000 WHEN 1 THEN NULL ELSE s_nationkey END FROM supplier
           UNION SELECT n_nationkey FROM nation),
r AS (SELECT DISTINCT r_regionkey, r_name FROM region)
SELECT u.nationkey, n.n_name AS nation_name, n.n_regionkey AS regionkey, r.r_name AS region_name
FROM u LEFT JOIN nation n ON u.nationkey = n.n_nationkey
LEFT JOIN r ON n.n_regionkey = r.r_regionkey
""")
def dim_enrich(spark, sf_dir):
    """J1 (key universe left-join directory) + J2 (left-join a distinct projection); unknown and absent keys stay."""
    t = TableSet(spark, sf_dir)
    k = F.col("s_suppkey") % 9
    supplier = t.supplier.select(F.when(k == 0, F.col("s_nationkey") + 1000).when(k == 1, F.lit(None)).otherwise(
        F.col("s_nationkey")).alias("s_nationkey"))
    u = _key_universe([(t.customer, "c_nationkey"), (supplier, "s_nationkey"), (t.nation, "n_nationkey")],
                      "nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("nation_name"),
                             F.col("n_regionkey").alias("regionkey"))
    region = distinct_projection(t.region, ["r_regionkey", "r_name"]).select(
        F.col("r_regionkey").alias("regionkey"), F.col("r_name").alias("region_name"))
    return enrich(enrich(u, nation, "nationkey"), region, "regionkey").select(
        "nationkey", "nation_name", "regionkey", "region_name")


@register("latest_per_key", """
SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                               ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
  FROM orders) t WHERE rn = 1
""")
def latest_per_key_query(spark, sf_dir):
    """Latest order per (customer, priority); ties broken by order key."""
    o = TableSet(spark, sf_dir).orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate",
                                              "o_totalprice")
    return latest_per_key(o, ["o_custkey", "o_orderpriority"], "o_orderdate",
                          tiebreak=[F.col("o_orderkey").desc()])


def results_shape(t: TableSet) -> DataFrame:
    """G9 on TPC-H: indicator vs latest target for the year and for the final year.

    Indicator and targets are cells of one generator over the nation totals, and
    meet again by grouping on (place, code): nothing is joined to itself.  A
    group holds at most one indicator per year and label and one target per year.
    """
    totals = level_totals(t).filter(F.col("level") == "nation")
    base = totals.select("place_id", "priority_label", "ref_year", "c", mean_of_cents("s", "c").alias("base"))
    target = lambda y: F.when(F.lit(y) > F.col("ref_year"), F.col("base") + F.lit(TARGET_STEP) * (F.lit(y) - F.col("ref_year")))
    cell = lambda year, value, n: F.struct(year.alias("year"), value.alias("value"), n.alias("n"))
    none = F.lit(None).cast("bigint")
    cells = base.select("place_id", "priority_label", "ref_year", F.inline(F.array(
        cell(F.col("ref_year"), F.col("base"), F.col("c")), *[cell(F.lit(y), target(y), none) for y in YEARS])))
    cells = cells.filter("value IS NOT NULL OR n IS NOT NULL")
    measured = F.col("n").isNotNull()
    # Targets get their code by label, indicators carry their own
    coded = enrich(cells, priority_dimension(t), "priority_label", "left").withColumn(
        "priority_code", F.when(measured, F.substring("priority_label", 1, 1)).otherwise(F.col("priority_code")))
    # Latest reference year per (place, code, target year); every indicator stays
    latest = latest_per_key(coded.withColumn("own", F.when(measured, F.col("priority_label"))),
                            ["place_id", "priority_code", "year", "own"], "ref_year")
    entry = F.struct("year", "value")
    groups = latest.groupBy("place_id", "priority_code").agg(
        F.collect_list(F.when(measured, F.struct("year", F.col("value").alias("actual"), F.col("n").alias("n_orders")))).alias("facts"),
        F.map_from_entries(F.collect_list(F.when(~measured & F.col("priority_code").isNotNull(), entry))).alias("targets"))
    facts = groups.select("place_id", "priority_code", "targets", F.inline("facts")).withColumns({
        "target_for_year": F.col("targets")[F.col("year")], "target_final": F.col("targets")[F.lit(FINAL_YEAR)]})       # W3
    nation_dim = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"),
                               "left").select(
        F.col("n_nationkey").cast("string").alias("place_id"),
        F.col("n_name").alias("nation_name"), F.col("r_name").alias("region_name"))
    joined = enrich(facts, nation_dim, "place_id").join(priority_dimension(t), "priority_code", "left")
    return joined.select(
        "year", "place_id", "nation_name", "region_name", "priority_code", "priority_label",
        "actual", "n_orders", "target_for_year",
        gap("actual", "target_for_year").alias("gap_for_year"),
        attained("actual", "target_for_year").alias("attained"),
        "target_final",
        reverse_gap("actual", "target_final").alias("gap_to_final"),
    )


_RESULTS_SQL = "WITH " + _FACTS_SQL + """,
ind AS (
  SELECT ref_year AS year, CAST(nationkey AS VARCHAR) AS place_id, substr(priority_label, 1, 1) AS priority_code,
         CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS DOUBLE) / CAST(100 AS DOUBLE) AS actual,
         count(*) AS n_orders
  FROM f GROUP BY ref_year, nationkey, priority_label),
nd AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS place_id, n_name AS nation_name, r_name AS region_name
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
lab AS (SELECT lt.*, dp.priority_code FROM lt LEFT JOIN dp ON lt.priority_label = dp.priority_label),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY level, place_id, priority_code, target_year
                                 ORDER BY ref_year DESC NULLS LAST, priority_label, target_value) AS rn
    FROM lab WHERE level = 'nation') t WHERE rn = 1),
fy AS (SELECT place_id, priority_code, target_year AS year, target_value AS target_for_year FROM latest),
fin AS (SELECT place_id, priority_code, target_value AS target_final FROM latest WHERE target_year = 2001)
SELECT ind.year, ind.place_id, nd.nation_name, nd.region_name, ind.priority_code, dp.priority_label,
       ind.actual, ind.n_orders, fy.target_for_year,
       round(ind.actual - fy.target_for_year, 2) AS gap_for_year,
       ind.actual >= fy.target_for_year AS attained,
       fin.target_final,
       round(fin.target_final - ind.actual, 2) AS gap_to_final
FROM ind
LEFT JOIN nd ON ind.place_id = nd.place_id
LEFT JOIN dp ON ind.priority_code = dp.priority_code
LEFT JOIN fy ON ind.place_id = fy.place_id AND ind.priority_code = fy.priority_code AND ind.year = fy.year
LEFT JOIN fin ON ind.place_id = fin.place_id AND ind.priority_code = fin.priority_code
"""


@register("fato_resultados_shape", _RESULTS_SQL)
def fato_resultados_shape(spark, sf_dir):
    """Star join of indicator, dimensions and latest targets."""
    return results_shape(TableSet(spark, sf_dir))


@register("monotone_targets", """
WITH pc AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
  FROM orders GROUP BY 1, 2),
w AS (
  SELECT c.c_nationkey AS nationkey,
         CAST(sum(cents) FILTER (WHERE y = 1995) AS DOUBLE) / CAST(100 AS DOUBLE) AS revenue_1995,
         CAST(sum(cents) FILTER (WHERE y = 1996) AS DOUBLE) / CAST(100 AS DOUBLE) AS revenue_1996,
         CAST(sum(cents) FILTER (WHERE y = 1997) AS DOUBLE) / CAST(100 AS DOUBLE) AS revenue_1997,
         CAST(sum(cents) FILTER (WHERE y = 1998) AS DOUBLE) / CAST(100 AS DOUBLE) AS revenue_1998,
         CAST(sum(cents) FILTER (WHERE y = 1999) AS DOUBLE) / CAST(100 AS DOUBLE) AS revenue_1999,
         CAST(sum(cents) FILTER (WHERE y = 2000) AS DOUBLE) / CAST(100 AS DOUBLE) AS revenue_2000,
         CAST(sum(cents) FILTER (WHERE y = 2001) AS DOUBLE) / CAST(100 AS DOUBLE) AS revenue_2001
  FROM pc JOIN customer c ON pc.o_custkey = c.c_custkey
  GROUP BY c.c_nationkey)
SELECT *,
       (revenue_1996 < revenue_1995) OR (revenue_1997 < revenue_1996) OR (revenue_1998 < revenue_1997)
       OR (revenue_1999 < revenue_1998) OR (revenue_2000 < revenue_1999) OR (revenue_2001 < revenue_2000) AS decreasing,
       (revenue_1995 IS NULL) <> (revenue_2001 IS NULL) AS null_parity
FROM w
""")
def monotone_targets(spark, sf_dir):
    """Q21 + Q22: wide yearly totals per nation; any drop; NULL parity of the ends."""
    t = TableSet(spark, sf_dir)
    per_cust = (t.orders.select("o_custkey", F.year("o_orderdate").alias("y"), to_cents("o_totalprice").alias("c"))
                .groupBy("o_custkey", "y").agg(F.sum("c").alias("cents")))
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nationkey"))
    cols = [f"revenue_{y}" for y in YEARS]
    wide = per_cust.join(cust, "o_custkey").groupBy("nationkey").agg(
        *[(F.sum(F.when(F.col("y") == y, F.col("cents").cast(EXACT))).cast("double") / F.lit(100.0))
          .alias(f"revenue_{y}")
          for y in YEARS])
    return wide.select("*", any_decrease(cols).alias("decreasing"),
                       (F.col(cols[0]).isNull() != F.col(cols[-1]).isNull()).alias("null_parity"))


_CHANGED_ORDERS_SQL = """
b AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW'))
"""


@register("table_reconcile", "WITH " + _CHANGED_ORDERS_SQL + """
SELECT 'only_in_a' AS side, * FROM (SELECT * FROM orders EXCEPT SELECT * FROM b) x
UNION ALL
SELECT 'only_in_b' AS side, * FROM (SELECT * FROM b EXCEPT SELECT * FROM orders) y
""")
def table_reconcile(spark, sf_dir):
    """U4: EXCEPT DISTINCT both ways between a table and a changed copy."""
    a = TableSet(spark, sf_dir).orders
    return reconcile(a, changed_orders(a))


def changed_orders(a: DataFrame) -> DataFrame:
    """A changed copy: low-priority pending orders removed, urgent totals +1."""
    return (a.filter(~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")))
             .withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1.0)
                         .otherwise(F.col("o_totalprice"))))


@register("reconcile_counts", "WITH " + _CHANGED_ORDERS_SQL + """
SELECT 'rows_a' AS metric, count(*) AS value FROM orders
UNION ALL SELECT 'rows_b', count(*) FROM b
UNION ALL SELECT 'only_in_a', count(*) FROM (SELECT * FROM orders EXCEPT SELECT * FROM b) x
UNION ALL SELECT 'only_in_b', count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM orders) y
""")
def reconcile_counts(spark, sf_dir):
    """U4 counts: rows per side and distinct rows found on one side only."""
    a = TableSet(spark, sf_dir).orders
    return reconcile_summary(a, changed_orders(a))


@register("orphan_keys", """
SELECT count(*) AS orphan_rows, count(DISTINCT l_orderkey) AS orphan_keys
FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus IN ('F', 'O'))
""")
def orphan_keys(spark, sf_dir):
    """Lines whose order is not among the open/fulfilled orders."""
    t = TableSet(spark, sf_dir)
    parent = t.orders.filter(F.col("o_orderstatus").isin("F", "O"))
    return orphan_summary(t.lineitem, parent, ["l_orderkey"], ["o_orderkey"])


@register("year_dimension", """
WITH b AS (SELECT min(year(o_orderdate)) AS first_year, max(year(o_orderdate)) AS last_year FROM orders)
SELECT CAST(y AS INTEGER) AS ano, CASE WHEN y <= last_year THEN 'realizado' ELSE 'projetado' END AS tipo_ano
FROM b, LATERAL (SELECT unnest(generate_series(first_year, last_year + 2)) AS y) g
""")
def year_dimension(spark, sf_dir):
    """S6 + C10: observed years of the data plus a two-year projection horizon."""
    o = TableSet(spark, sf_dir).orders
    bounds = o.agg(F.min(F.year("o_orderdate")).alias("first_year"), F.max(F.year("o_orderdate")).alias("last_year"))
    years = years_between(bounds, F.col("first_year"), F.col("last_year") + 2)
    return years.select("ano", classify_period("ano", F.col("last_year")).alias("tipo_ano"))


@register("layout_write", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def layout_write(spark, sf_dir):
    """S2 + S3: overwrite a clustered copy on shared storage and read it back."""
    orders = TableSet(spark, sf_dir).orders
    path = shared_path(spark, "layout_write", unique=True)
    write_table(orders, path, clustered_fields=["o_orderdate", "o_custkey"])
    files.remove_at_exit(spark, path)
    return read_table(spark, path)


@register("reconcile_all", """
WITH a AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders),
b AS (SELECT o_custkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
      FROM orders WHERE o_orderkey % 7 <> 0
      UNION ALL SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 11 = 0)
SELECT 'only_in_a' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) x
UNION ALL
SELECT 'only_in_b' AS side, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) y
""")
def reconcile_all(spark, sf_dir):
    """U4: EXCEPT ALL both ways, over rows that repeat."""
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    orders = TableSet(spark, sf_dir).orders
    k = F.col("o_orderkey")
    moved = orders.withColumn("o_orderpriority", F.when(k % 10 == 0, F.lit("1-URGENT")).otherwise(F.col("o_orderpriority")))
    changed = moved.filter(k % 7 != 0).select(*columns).unionAll(orders.filter(k % 11 == 0).select(*columns))
    return reconcile(orders.select(*columns), changed, keep_duplicates=True)
