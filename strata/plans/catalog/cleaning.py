"""Catalogue: sources, projection and cleaning operators on the driver tables.

Dirty variants of clean TPC-H columns are derived from the rows themselves
(key residues pick which variant a row gets), so every query still reads and
returns whole tables.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import (
    cast_columns, decode, decode_flags, json_int, normalize_label, normalized_text,
    pad_id_guarded, pad_id_unguarded, trimmed_text, upper_code,
)
from strata.operators.quality import require_columns
from strata.plans.catalog.registry import register
from strata.sources import TableSet, stamp

# --- Fixed values: labels used by the catalogue's decoding queries -------------
RETURN_FLAG_LABELS = {"A": "Accepted", "N": "Not returned"}   # 'R' deliberately unmapped
STATUS_LABELS = {"O": "Open", "F": "Fulfilled"}               # 'P' deliberately unmapped
SEGMENT_VARIANTS = {"Machinery": ["machinery", "machines", "maquinária"]}
KNOWN_SEGMENTS = ["Building", "Automobile", "Machinery"]
ORDERS_CONTRACT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@register("bronze_stamp", """
SELECT n_nationkey, n_name, n_regionkey,
       TIMESTAMP '2024-01-01 06:00:00' AS _ingestao_timestamp,
       'tpch.nation' AS _fonte
FROM nation
""")
def bronze_stamp(spark, sf_dir):
    """Raw copy + arrival time + source name (fixed time for repeatability)."""
    return stamp(TableSet(spark, sf_dir).nation, "tpch.nation", at="2024-01-01 06:00:00")


@register("contract_projection", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status_code,
       o_totalprice AS total_price, o_orderdate AS order_date
FROM orders
""")
def contract_projection(spark, sf_dir):
    """Q1 + P1 + P3: check required names, keep the contract list, rename."""
    orders = TableSet(spark, sf_dir).orders
    require_columns(orders, ORDERS_CONTRACT)
    return orders.select(*ORDERS_CONTRACT).withColumnsRenamed({
        "o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status_code",
        "o_totalprice": "total_price", "o_orderdate": "order_date",
    })


def _raw_segment():
    k = F.col("c_custkey") % 5
    seg = F.col("c_mktsegment")
    return (F.when(k == 0, F.concat(F.lit("  "), F.lower(seg), F.lit(" ")))
             .when(k == 1, F.lit(""))
             .when(k == 2, F.lit("   "))
             .when(k == 3, F.concat(F.lit("\t"), seg))
             .otherwise(seg))


@register("text_normalise", """
WITH d AS (
  SELECT c_custkey,
         CASE c_custkey % 5 WHEN 0 THEN '  ' || lower(c_mktsegment) || ' '
                            WHEN 1 THEN '' WHEN 2 THEN '   '
                            WHEN 3 THEN chr(9) || c_mktsegment
                            ELSE c_mktsegment END AS raw_segment
  FROM customer)
SELECT c_custkey, raw_segment, trim(raw_segment) AS segment_trimmed,
       nullif(trim(raw_segment), '') AS segment_clean,
       upper(nullif(trim(raw_segment), '')) AS segment_code
FROM d
""")
def text_normalise(spark, sf_dir):
    """C1 + C7: trim keeps '' (and tabs), normalised text turns '' into NULL."""
    c = TableSet(spark, sf_dir).customer.select("c_custkey", _raw_segment().alias("raw_segment"))
    return c.select(
        "c_custkey", "raw_segment",
        trimmed_text("raw_segment").alias("segment_trimmed"),
        normalized_text("raw_segment").alias("segment_clean"),
        upper_code("raw_segment").alias("segment_code"),
    )


@register("id_padding", """
WITH d AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS id_txt,
         CAST(c_custkey + 100000000 AS VARCHAR) AS long_txt, c_name
  FROM customer)
SELECT c_custkey,
       CASE WHEN regexp_full_match(nullif(trim(id_txt), ''), '[0-9]{1,7}')
            THEN lpad(nullif(trim(id_txt), ''), 7, '0') ELSE nullif(trim(id_txt), '') END AS id_guarded,
       lpad(trim(id_txt), 7, '0') AS id_unguarded,
       CASE WHEN regexp_full_match(nullif(trim(long_txt), ''), '[0-9]{1,7}')
            THEN lpad(nullif(trim(long_txt), ''), 7, '0') ELSE nullif(trim(long_txt), '') END AS long_id_guarded,
       lpad(trim(long_txt), 7, '0') AS long_id_unguarded,
       CASE WHEN regexp_full_match(nullif(trim(c_name), ''), '[0-9]{1,7}')
            THEN lpad(nullif(trim(c_name), ''), 7, '0') ELSE nullif(trim(c_name), '') END AS name_guarded,
       lpad(c_name, 7, '0') AS name_unguarded
FROM d
""")
def id_padding(spark, sf_dir):
    """C2 guarded padding vs C3 unguarded padding (which truncates long ids)."""
    c = TableSet(spark, sf_dir).customer.select(
        "c_custkey",
        F.col("c_custkey").cast("string").alias("id_txt"),
        (F.col("c_custkey") + 100000000).cast("string").alias("long_txt"),
        "c_name",
    )
    return c.select(
        "c_custkey",
        pad_id_guarded(normalized_text("id_txt")).alias("id_guarded"),
        pad_id_unguarded("id_txt").alias("id_unguarded"),
        pad_id_guarded(normalized_text("long_txt")).alias("long_id_guarded"),
        pad_id_unguarded("long_txt").alias("long_id_unguarded"),
        pad_id_guarded(normalized_text("c_name")).alias("name_guarded"),
        pad_id_unguarded("c_name", trim=False).alias("name_unguarded"),
    )


@register("code_decode", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
       CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'Not returned' END AS returnflag_label,
       l_linestatus,
       CASE l_linestatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Fulfilled' END AS linestatus_label
FROM lineitem
""")
def code_decode(spark, sf_dir):
    """C4: literal-map decode; an unmapped code gives a NULL label."""
    li = TableSet(spark, sf_dir).lineitem
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        decode("l_returnflag", RETURN_FLAG_LABELS).alias("returnflag_label"),
        "l_linestatus",
        decode("l_linestatus", STATUS_LABELS).alias("linestatus_label"),
    )


@register("flag_decode", """
WITH d AS (
  SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 2 ELSE quality END AS q,
         CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE toxic END AS t
  FROM labels)
SELECT doc_id, q AS quality_id, t AS toxic_id,
       CASE WHEN q = 1 THEN true WHEN q = 0 THEN false END AS quality,
       CASE WHEN t = 1 THEN true WHEN t = 0 THEN false END AS toxic
FROM d
""")
def flag_decode(spark, sf_dir):
    """Each 0/1 flag kept as ``x_id`` int plus decoded boolean ``x``; absent and other values decode to NULL."""
    k, j = F.col("doc_id") % 7, F.col("doc_id") % 5
    raw = TableSet(spark, sf_dir).labels.select(
        "doc_id", F.when(k == 0, F.lit(None)).when(k == 1, F.lit(2)).otherwise(F.col("quality")).alias("quality"),
        F.when(j == 0, F.lit(None)).when(j == 1, F.lit(-1)).otherwise(F.col("toxic")).alias("toxic"))
    return decode_flags(raw, ["quality", "toxic"])


def _raw_label():
    k = F.col("c_custkey") % 6
    seg = F.col("c_mktsegment")
    return (F.when(k == 0, seg)
             .when(k == 1, F.concat(F.lit("  "), F.lower(seg), F.lit("  ")))
             .when(k == 2, F.lit(""))
             .when(k == 3, F.lit("   "))
             .when(k == 4, F.concat(F.lower(seg), F.lit(" goods")))
             .otherwise(F.when(seg == "MACHINERY", F.lit("Maquinária"))
                         .otherwise(F.concat(seg, F.lit(" (b2b)")))))


_LABEL_SQL = """
WITH d AS (
  SELECT c_custkey,
         CASE c_custkey % 6 WHEN 0 THEN c_mktsegment
                            WHEN 1 THEN '  ' || lower(c_mktsegment) || '  '
                            WHEN 2 THEN '' WHEN 3 THEN '   '
                            WHEN 4 THEN lower(c_mktsegment) || ' goods'
                            ELSE CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Maquinária'
                                      ELSE c_mktsegment || ' (b2b)' END END AS raw_label
  FROM customer),
n AS (SELECT c_custkey, raw_label, trim(raw_label) AS t, lower(trim(raw_label)) AS l FROM d)
SELECT c_custkey, raw_label,
       CASE WHEN l IN ('machinery', 'machines', 'maquinária') THEN 'Machinery'
            WHEN t = '' THEN NULL
            ELSE array_to_string(list_transform(string_split(l, ' '),
                                 lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') END AS label
FROM n
"""


@register("label_normalise", _LABEL_SQL)
def label_normalise(spark, sf_dir):
    """Known spellings -> canonical, '' -> NULL, otherwise title case."""
    c = TableSet(spark, sf_dir).customer.select("c_custkey", _raw_label().alias("raw_label"))
    return c.select("c_custkey", "raw_label", normalize_label("raw_label", SEGMENT_VARIANTS).alias("label"))


@register("measure_cast", r"""
WITH d AS (
  SELECT p_partkey,
         CASE p_partkey % 7 WHEN 0 THEN ' ' || CAST(p_size AS VARCHAR) || ' '
                            WHEN 1 THEN CAST(p_size AS VARCHAR) || '.5'
                            WHEN 2 THEN 'n/a' WHEN 3 THEN ''
                            ELSE CAST(p_size AS VARCHAR) END AS size_txt,
         CASE p_partkey % 5 WHEN 0 THEN CAST(p_retailprice AS VARCHAR) || 'x'
                            WHEN 1 THEN ' ' || CAST(p_retailprice AS VARCHAR) || ' '
                            WHEN 2 THEN '-' || CAST(p_retailprice AS VARCHAR)
                            WHEN 3 THEN '1.5e3'
                            ELSE CAST(p_retailprice AS VARCHAR) END AS price_txt
  FROM part)
SELECT p_partkey,
       CASE WHEN regexp_full_match(trim(size_txt), '[+-]?[0-9]+([.][0-9]*)?')
            THEN TRY_CAST(trunc(TRY_CAST(trim(size_txt) AS DECIMAL(30, 6))) AS INTEGER) END AS size_txt,
       CASE WHEN regexp_full_match(trim(price_txt),
                                   '([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?(?i:inf|infinity)|(?i:nan))')
            THEN TRY_CAST(trim(price_txt) AS DOUBLE) END AS price_txt
FROM d
""")
def measure_cast(spark, sf_dir):
    """P5 + C8: bulk guarded casts of text measures; malformed text -> NULL."""
    p = TableSet(spark, sf_dir).part
    k, j = F.col("p_partkey") % 7, F.col("p_partkey") % 5
    size = F.col("p_size").cast("string")
    price = F.col("p_retailprice").cast("string")
    d = p.select(
        "p_partkey",
        F.when(k == 0, F.concat(F.lit(" "), size, F.lit(" ")))
         .when(k == 1, F.concat(size, F.lit(".5")))
         .when(k == 2, F.lit("n/a")).when(k == 3, F.lit("")).otherwise(size).alias("size_txt"),
        F.when(j == 0, F.concat(price, F.lit("x")))
         .when(j == 1, F.concat(F.lit(" "), price, F.lit(" ")))
         .when(j == 2, F.concat(F.lit("-"), price))
         .when(j == 3, F.lit("1.5e3")).otherwise(price).alias("price_txt"),
    )
    return cast_columns(d, {"size_txt": "int", "price_txt": "double"})


@register("event_parse", r"""
SELECT event_id, ts, user_id, lpad(CAST(user_id AS VARCHAR), 7, '0') AS user_code, event_type, value,
       CASE WHEN regexp_full_match(trim(CAST(json_value(props, '$.k') AS VARCHAR)), '[+-]?[0-9]+')
            THEN TRY_CAST(trim(CAST(json_value(props, '$.k') AS VARCHAR)) AS INTEGER) END AS k
FROM events
""")
def event_parse(spark, sf_dir):
    """T1 / C11 on the events table: scalar JSON field typed with a guarded cast."""
    ev = TableSet(spark, sf_dir).events
    return ev.select(
        "event_id", "ts", "user_id",
        pad_id_unguarded("user_id", 7, trim=False).alias("user_code"),
        "event_type", "value", json_int("props", "$.k").alias("k"),
    )


@register("code_decode_join", """
WITH c AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_nationkey + 1000 WHEN 1 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer)
SELECT c.c_custkey, c.c_nationkey, n.n_name AS nation_label
FROM c
LEFT JOIN (SELECT n_nationkey, min(n_name) AS n_name FROM nation GROUP BY n_nationkey) n
  ON c.c_nationkey = n.n_nationkey
""")
def code_decode_join(spark, sf_dir):
    """C4 for code lists too large for a literal map: left join to a lookup
    table de-duplicated on its code, so fact rows are never multiplied; unknown
    and absent codes keep a NULL label."""
    from strata.functions import decode_join
    t = TableSet(spark, sf_dir)
    k = F.col("c_custkey") % 6
    code = F.when(k == 0, F.col("c_nationkey") + 1000).when(k == 1, F.lit(None)).otherwise(F.col("c_nationkey"))
    c = t.customer.select("c_custkey", code.alias("c_nationkey"))
    return decode_join(c, "c_nationkey", t.nation, "n_nationkey", "n_name", "nation_label")
