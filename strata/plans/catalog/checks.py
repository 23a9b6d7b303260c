"""Catalogue: dedup and data-quality operators on the driver tables."""
from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from strata.functions import decode, decode_flags, filled_count, normalize_label
from strata.operators import quality as Q
from strata.operators.dedup import latest_per_key
from strata.operators.profile import by_frequency, preview, value_profile
from strata.plans.catalog.cleaning import KNOWN_SEGMENTS, RETURN_FLAG_LABELS, SEGMENT_VARIANTS
from strata.plans.catalog.registry import register
from strata.sources import TableSet

LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

_DEDUP_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (
  SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey ASC NULLS LAST, l_suppkey ASC NULLS FIRST,
               l_quantity ASC NULLS LAST, l_extendedprice ASC NULLS LAST, l_discount ASC NULLS FIRST,
               l_tax ASC NULLS LAST, l_returnflag ASC NULLS LAST, l_linestatus ASC NULLS FIRST,
               l_shipdate ASC NULLS LAST) AS rn
  FROM lineitem) t
WHERE rn = 1
"""


def dedup_lineitem(li: DataFrame) -> DataFrame:
    """Latest ship date per (order, line); remaining columns break ties."""
    return latest_per_key(li, LINEITEM_KEYS, "l_shipdate")


@register("dedup_natural_key", _DEDUP_SQL)
def dedup_natural_key(spark, sf_dir):
    """Deterministic keep-one-per-key (partial WindowGroupLimit before the shuffle)."""
    return dedup_lineitem(TableSet(spark, sf_dir).lineitem)


@register("duplicate_keys", """
SELECT count(*) AS dup_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS dup_rows,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) t
""")
def duplicate_keys(spark, sf_dir):
    """Q2 / A3: keys with more than one row."""
    return Q.duplicate_summary(TableSet(spark, sf_dir).lineitem, LINEITEM_KEYS)


@register("row_reconciliation", """
SELECT CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_out, CAST(sum(n) AS BIGINT) - count(*) AS rows_removed
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) t
""")
def row_reconciliation(spark, sf_dir):
    """Q3: rows in and out of the dedup step, in one grouped job."""
    return Q.row_reconciliation(TableSet(spark, sf_dir).lineitem, LINEITEM_KEYS)


def lineitem_checks():
    """The lineitem contract: (stage, checks) in report order."""
    pre = [
        Q.row_count(),
        Q.outside_domain("l_returnflag", ["A", "N", "R"], severity=Q.GATE),
        Q.outside_domain("l_linestatus", ["O", "F"], severity=Q.GATE),
        Q.rule("rare_code", "l_linenumber", F.col("l_linenumber") == 7),
    ]
    post = [
        Q.row_count(),
        *Q.nulls(*LINEITEM_COLUMNS),
        Q.rule("format", "l_orderkey", ~F.col("l_orderkey").cast("string").rlike("^[0-9]{1,7}$")),
        Q.pattern_mismatch("l_returnflag", "^[AN]$"),
        Q.out_of_range("l_discount", 0.0, 0.1),
        Q.out_of_range("l_tax", 0.0, 0.08),
        Q.out_of_range("l_quantity", 0.0, None, name="sign", low_inclusive=False),
        Q.out_of_range("l_extendedprice", 0.0, None, name="sign"),
        Q.required_when("required_when_returned", F.col("l_returnflag") == "R",
                        ["l_quantity", "l_extendedprice"]),
        Q.rule("returned_but_open", "l_returnflag,l_linestatus",
               (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")),
        Q.rule("filled_without_shipdate", "l_shipdate",
               (F.col("l_linestatus") == "F") & F.col("l_shipdate").isNull()),
    ]
    return pre, post


# (stage, check_name, column_name, SQL predicate, severity) — the oracle's own
# statement of the same contract.
_LINEITEM_SQL_CHECKS = [
    ("pre", "row_count", None, "true", "warn"),
    ("pre", "domain", "l_returnflag", "l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A','N','R')", "gate"),
    ("pre", "domain", "l_linestatus", "l_linestatus IS NOT NULL AND l_linestatus NOT IN ('O','F')", "gate"),
    ("pre", "rare_code", "l_linenumber", "l_linenumber = 7", "warn"),
    ("post", "row_count", None, "true", "warn"),
    *[("post", "nulls", c, f"{c} IS NULL", "warn") for c in LINEITEM_COLUMNS],
    ("post", "format", "l_orderkey", "NOT regexp_full_match(CAST(l_orderkey AS VARCHAR), '[0-9]{1,7}')", "warn"),
    ("post", "format", "l_returnflag", "l_returnflag IS NOT NULL AND NOT regexp_full_match(l_returnflag, '[AN]')", "warn"),
    ("post", "range", "l_discount", "l_discount < 0.0 OR l_discount > 0.1 OR isnan(l_discount)", "warn"),
    ("post", "range", "l_tax", "l_tax < 0.0 OR l_tax > 0.08 OR isnan(l_tax)", "warn"),
    ("post", "sign", "l_quantity", "l_quantity <= 0.0 OR isnan(l_quantity)", "warn"),
    ("post", "sign", "l_extendedprice", "l_extendedprice < 0.0 OR isnan(l_extendedprice)", "warn"),
    ("post", "required_when_returned", "l_quantity,l_extendedprice",
     "l_returnflag = 'R' AND (l_quantity IS NULL OR l_extendedprice IS NULL)", "warn"),
    ("post", "returned_but_open", "l_returnflag,l_linestatus", "l_returnflag = 'R' AND l_linestatus = 'O'", "warn"),
    ("post", "filled_without_shipdate", "l_shipdate", "l_linestatus = 'F' AND l_shipdate IS NULL", "warn"),
]


def _report_sql(checks, sources):
    parts = []
    for stage, name, col, pred, sev in checks:
        col_sql = "CAST(NULL AS VARCHAR)" if col is None else f"'{col}'"
        parts.append(f"SELECT '{stage}' AS stage, '{name}' AS check_name, {col_sql} AS column_name, "
                     f"count(*) FILTER (WHERE {pred}) AS violations, '{sev}' AS severity FROM {sources[stage]}")
    return "\nUNION ALL\n".join(parts)


_QUALITY_REPORT_SQL = f"WITH dedup AS ({_DEDUP_SQL})\n" + _report_sql(
    _LINEITEM_SQL_CHECKS, {"pre": "lineitem", "post": "dedup"})


@register("quality_report", _QUALITY_REPORT_SQL)
def quality_report(spark, sf_dir):
    """Q4-Q6, Q12-Q15, Q24: one aggregation pass per stage, long-form report."""
    li = TableSet(spark, sf_dir).lineitem
    pre, post = lineitem_checks()
    return Q.run_checks(li, pre, "pre").unionByName(Q.run_checks(dedup_lineitem(li), post, "post"))


_GATES_SQL_CHECKS = [
    ("labels", "raw_flag_domain", "quality", "quality IS NOT NULL AND trim(CAST(quality AS VARCHAR)) NOT IN ('0','1')"),
    ("labels", "raw_flag_domain", "toxic", "toxic IS NOT NULL AND trim(CAST(toxic AS VARCHAR)) NOT IN ('0','1')"),
    ("labels", "undecoded", "quality_id", "quality IS NOT NULL AND quality NOT IN (0, 1)"),
    ("labels", "undecoded", "toxic_id", "toxic IS NOT NULL AND toxic NOT IN (0, 1)"),
    ("orders", "domain", "o_orderstatus", "o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('O','F','P')"),
    ("orders", "domain", "o_orderpriority",
     "o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW')"),
]

_GATES_SQL_SOURCES = {
    "labels": "(SELECT CASE WHEN doc_id % 7 = 1 THEN 2 ELSE quality END AS quality, CASE WHEN doc_id % 5 = 1 THEN -1 ELSE toxic END AS toxic FROM labels) l",
    "orders": "(SELECT o_orderpriority, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders) o",
}


@register("quality_gates", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS stage, '{n}' AS check_name, '{c}' AS column_name, count(*) FILTER (WHERE {p}) AS violations, "
    f"'gate' AS severity, count(*) FILTER (WHERE {p}) = 0 AS passed FROM {_GATES_SQL_SOURCES[t]}"
    for t, n, c, p in _GATES_SQL_CHECKS))
def quality_gates(spark, sf_dir):
    """Q7-Q9 + Q26: blocking checks on rows with wrong flags and statuses; ``passed`` is what ``enforce`` acts on."""
    t = TableSet(spark, sf_dir)
    labels = t.labels.select("doc_id", F.when(F.col("doc_id") % 7 == 1, F.lit(2)).otherwise(F.col("quality")).alias("quality"),
                             F.when(F.col("doc_id") % 5 == 1, F.lit(-1)).otherwise(F.col("toxic")).alias("toxic"))
    orders = t.orders.select("o_orderpriority", F.when(F.col("o_orderkey") % 11 == 0, F.lit("X")).otherwise(
        F.col("o_orderstatus")).alias("o_orderstatus"))
    # raw copies ride along with the decoded columns, so raw and decoded
    # checks run in the same single pass
    combined = decode_flags(labels.withColumns({"raw_quality": F.col("quality"), "raw_toxic": F.col("toxic")}),
                            ["quality", "toxic"])
    label_checks = [
        Q.Check("raw_flag_domain", "quality", Q.raw_flag_domain("raw_quality").violation, Q.GATE),
        Q.Check("raw_flag_domain", "toxic", Q.raw_flag_domain("raw_toxic").violation, Q.GATE),
        Q.undecoded("quality_id", "quality"),
        Q.undecoded("toxic_id", "toxic"),
    ]
    order_checks = [
        Q.outside_domain("o_orderstatus", ["O", "F", "P"], severity=Q.GATE),
        Q.outside_domain("o_orderpriority", PRIORITIES, severity=Q.GATE),
    ]
    report = Q.run_checks(combined, label_checks, "labels").unionByName(
        Q.run_checks(orders, order_checks, "orders"))
    return report.withColumn("passed", F.col("violations") == 0)


@register("unknown_codes", """
SELECT 'unmapped_code' AS listing, 'l_returnflag' AS column_name, l_returnflag AS value, count(*) AS n
FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N')
GROUP BY l_returnflag
UNION ALL
SELECT 'unknown_label', 'c_mktsegment', label, count(*)
FROM (""" + """
  SELECT CASE WHEN lower(trim(c_mktsegment)) IN ('machinery', 'machines', 'maquinária') THEN 'Machinery'
              WHEN trim(c_mktsegment) = '' THEN NULL
              ELSE array_to_string(list_transform(string_split(lower(trim(c_mktsegment)), ' '),
                                   lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') END AS label
  FROM customer) t
WHERE label IS NOT NULL AND label NOT IN ('Building', 'Automobile', 'Machinery')
GROUP BY label
""")
def unknown_codes(spark, sf_dir):
    """Q10 unmapped codes + Q11 unknown labels, as frequency listings."""
    t = TableSet(spark, sf_dir)
    codes = t.lineitem.select("l_returnflag", decode("l_returnflag", RETURN_FLAG_LABELS).alias("label"))
    q10 = Q.unmapped_codes(codes, "l_returnflag", "label").select(
        F.lit("unmapped_code").alias("listing"), F.lit("l_returnflag").alias("column_name"),
        F.col("l_returnflag").alias("value"), "n")
    labels = t.customer.select(normalize_label("c_mktsegment", SEGMENT_VARIANTS).alias("label"))
    q11 = Q.unknown_labels(labels, "label", KNOWN_SEGMENTS).select(
        F.lit("unknown_label").alias("listing"), F.lit("c_mktsegment").alias("column_name"),
        F.col("label").alias("value"), "n")
    return q10.unionByName(q11)


@register("domain_profile", """
SELECT 'orders' AS table_name, column_name, value, count(*) AS n FROM (
  SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders) t
GROUP BY column_name, value
UNION ALL
SELECT 'lineitem', column_name, value, count(*) FROM (
  SELECT 'l_returnflag' AS column_name, l_returnflag AS value FROM lineitem
  UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem) t
GROUP BY column_name, value
""")
def domain_profile(spark, sf_dir):
    """Q25 + O1: value frequencies of listed columns, one job per table."""
    t = TableSet(spark, sf_dir)
    o = value_profile(t.orders, ["o_orderstatus", "o_orderpriority"]).select(F.lit("orders").alias("table_name"), "*")
    li = value_profile(t.lineitem, ["l_returnflag", "l_linestatus"]).select(F.lit("lineitem").alias("table_name"), "*")
    return by_frequency(o.unionByName(li), "n", ["table_name", "column_name", "value"])


@register("functional_dependency", """
SELECT p_brand, count(DISTINCT p_type) AS n_values
FROM part WHERE p_brand IS NOT NULL
GROUP BY p_brand HAVING count(DISTINCT p_type) > 1
""")
def functional_dependency(spark, sf_dir):
    """Q16: brands mapping to more than one part type."""
    return Q.functional_dependency(TableSet(spark, sf_dir).part, ["p_brand"], "p_type", skip_null=["p_brand"])


def _shares():
    ln = F.col("l_linenumber")
    d, tx = F.col("l_discount"), F.col("l_tax")
    return [
        F.when(ln.isin(3, 4), F.lit(None)).otherwise(d).alias("share_a"),
        F.when(ln.isin(3, 4), F.lit(None)).otherwise(tx).alias("share_b"),
        F.when(ln.isin(2, 3), F.lit(None)).when(ln >= 5, 1 - d).otherwise(1 - d - tx).alias("share_c"),
    ]


@register("level_completeness", """
WITH s AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year,
         CASE WHEN l_linenumber IN (3, 4) THEN NULL ELSE l_discount END AS share_a,
         CASE WHEN l_linenumber IN (3, 4) THEN NULL ELSE l_tax END AS share_b,
         CASE WHEN l_linenumber IN (2, 3) THEN NULL WHEN l_linenumber >= 5 THEN 1 - l_discount
              ELSE 1 - l_discount - l_tax END AS share_c
  FROM lineitem),
f AS (
  SELECT ship_year,
         (CASE WHEN share_a IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN share_b IS NOT NULL THEN 1 ELSE 0 END
          + CASE WHEN share_c IS NOT NULL THEN 1 ELSE 0 END) AS n_filled,
         coalesce(share_a, 0.0) + coalesce(share_b, 0.0) + coalesce(share_c, 0.0) AS total
  FROM s)
SELECT ship_year, n_filled, count(*) AS n_rows,
       count(*) FILTER (WHERE n_filled > 0 AND n_filled < 3) AS n_partial,
       count(*) FILTER (WHERE n_filled = 3 AND (total < 0.999 OR total > 1.001)) AS n_bad_sum
FROM f GROUP BY ship_year, n_filled
""")
def level_completeness(spark, sf_dir):
    """A7 + Q17 + Q18 + Q19: fill count and share sum per row, distribution per year."""
    cols = ["share_a", "share_b", "share_c"]
    s = TableSet(spark, sf_dir).lineitem.select(F.year("l_shipdate").alias("ship_year"), *_shares())
    f = s.select("ship_year", filled_count(cols).alias("n_filled"), *cols)
    return f.groupBy("ship_year", "n_filled").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(Q.partial_fill(cols).violation).alias("n_partial"),
        F.count_if(Q.sum_outside(cols, 0.999, 1.001).violation).alias("n_bad_sum"),
    )


@register("coverage_by_year", """
SELECT order_year, count(DISTINCT c.c_nationkey) AS n_nations
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_custkey FROM orders) o
JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY order_year
""")
def coverage_by_year(spark, sf_dir):
    """Q20: distinct nations ordering per year.

    (year, customer) pairs are de-duplicated before the join, so the join and
    the distinct count see one row per pair, not one per order.
    """
    t = TableSet(spark, sf_dir)
    pairs = t.orders.select(F.year("o_orderdate").alias("order_year"), "o_custkey").distinct()
    joined = pairs.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    return Q.distinct_per_group(joined, ["order_year"], "c_nationkey", "n_nations")


@register("nulls_by_year", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
       count(*) FILTER (WHERE CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END IS NULL) AS nulls_o_totalprice,
       count(*) FILTER (WHERE CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END IS NULL) AS nulls_o_orderpriority,
       count(*) FILTER (WHERE CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END IS NULL) AS nulls_o_custkey
FROM orders GROUP BY 1
""")
def nulls_by_year(spark, sf_dir):
    """NULLs per column per year in one grouped pass."""
    o = TableSet(spark, sf_dir).orders
    k = F.col("o_orderkey")
    d = o.select(
        F.year("o_orderdate").alias("order_year"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when((F.col("o_orderstatus") == "P") & (k % 3 == 0), F.lit(None))
         .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"),
    )
    return Q.nulls_per_group(d, ["order_year"], ["o_totalprice", "o_orderpriority", "o_custkey"])


@register("profile_preview", """
SELECT column_name, value, count(*) AS n FROM (
  SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
  UNION ALL SELECT 'order_year', CAST(year(o_orderdate) AS VARCHAR) FROM orders) t
GROUP BY column_name, value
ORDER BY n DESC, column_name ASC, value ASC NULLS FIRST
LIMIT 10
""")
def profile_preview(spark, sf_dir):
    """O3 + O1: the ten most frequent values (a bounded preview; ties broken by name, value)."""
    o = TableSet(spark, sf_dir).orders.select(
        "o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("string").alias("order_year"))
    prof = value_profile(o, ["o_orderstatus", "o_orderpriority", "order_year"])
    return preview(prof, 10, [F.col("n").desc(), F.col("column_name").asc(), F.col("value").asc_nulls_first()])
