"""Dedup, quality engine, reshape and star operators."""
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.dedup import keep_one_per_key, latest_per_key
from strata.operators.profile import value_profile
from strata.operators.reshape import key_universe, pair_universe, reconcile, reconcile_summary, unpivot_columns
from strata.operators.star import enrich, orphan_summary

ROWS = [(1, "a", 10.0), (1, "a", 5.0), (1, "b", None), (2, None, 1.0), (None, "c", 2.0), (None, "c", 3.0)]
SCHEMA = "k int, v string, x double"


def test_dedup_deterministic_and_order_independent(spark):
    expected = None
    for seed in range(3):
        rows = ROWS[:]
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        got = sorted((tuple(r) for r in keep_one_per_key(df, ["k"]).collect()), key=str)
        expected = expected or got
        assert got == expected
    # NULL keys form one group; first row under (v asc nulls first, x asc nulls first)
    assert sorted(expected, key=str) == sorted([(1, "a", 5.0), (2, None, 1.0), (None, "c", 2.0)], key=str)


def test_dedup_idempotent(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    once = keep_one_per_key(df, ["k", "v"])
    twice = keep_one_per_key(once, ["k", "v"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_latest_per_key_null_time_loses(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 5, 2), (1, 5, 3), (2, None, 4)], "k int, t int, id int")
    got = sorted((tuple(r) for r in latest_per_key(df, ["k"], "t", [F.col("id").desc()]).collect()), key=str)
    assert got == [(1, 5, 3), (2, None, 4)]


def test_dedup_plans_partial_limit_before_shuffle(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = keep_one_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_one_pass_report_equals_per_metric_counts(spark):
    df = spark.createDataFrame(ROWS * 3, SCHEMA)
    checks = [Q.row_count(), *Q.nulls("k", "v", "x"), Q.outside_domain("v", ["a", "b"]),
              Q.out_of_range("x", 0.0, 6.0), Q.rule("big", "x", F.col("x") > 4)]
    report = {(r.check_name, r.column_name): r.violations for r in Q.run_checks(df, checks).collect()}
    for c in checks:
        assert report[(c.check_name, c.column_name)] == df.filter(c.violation).count()


def test_empty_input_gives_zeros_not_errors(spark):
    df = spark.createDataFrame([], SCHEMA)
    report = Q.run_checks(df, [Q.row_count(), *Q.nulls("k"), Q.outside_domain("v", ["a"], severity=Q.GATE)])
    assert [r.violations for r in report.collect()] == [0, 0, 0]
    Q.enforce(report)  # no gate failed


def test_gates_raise(spark):
    df = spark.createDataFrame([("1",), ("2",), ("1.0",), (None,)], "f string")
    report = Q.run_checks(df, [Q.raw_flag_domain("f")])
    assert report.first().violations == 2
    with pytest.raises(Q.QualityGateError):
        Q.enforce(report)
    with pytest.raises(Q.QualityGateError):
        Q.require_columns(df, ["f", "g"])


def test_grouped_checks(spark):
    df = spark.createDataFrame([(1, "s1", "m1"), (1, "s1", "m2"), (1, "s2", "m1"), (2, "s1", "m1"), (1, None, "m3")],
                               "ano int, escola string, mun string")
    fd = Q.functional_dependency(df, ["ano", "escola"], "mun", skip_null=["escola"]).collect()
    assert [(r.ano, r.escola, r.n_values) for r in fd] == [(1, "s1", 2)]
    s = Q.duplicate_summary(df, ["ano", "escola"]).first()
    assert (s.dup_keys, s.dup_rows, s.surplus_rows) == (1, 2, 1)
    r = Q.row_reconciliation(df, ["ano", "escola"]).first()
    assert (r.rows_in, r.rows_out, r.rows_removed) == (5, 4, 1)
    empty = Q.duplicate_summary(df.limit(0), ["ano"]).first()
    assert (empty.dup_keys, empty.dup_rows) == (0, 0)


def test_unpivot_drops_nulls_and_counts_cells(spark):
    df = spark.createDataFrame([(1, 1.0, None, 3.0), (2, None, None, None)], "id int, a double, b double, c double")
    long = unpivot_columns(df, ["id"], {2024: "a", 2025: "b", 2026: "c"}, "year", "value")
    assert sorted(tuple(r) for r in long.collect()) == [(1, 2024, 1.0), (1, 2026, 3.0)]
    kept = unpivot_columns(df, ["id"], {2024: "a", 2025: "b", 2026: "c"}, "year", "value", drop_nulls=False)
    assert kept.count() == 6


def test_universes_and_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, None)], "k int, v string")
    assert sorted(r[0] for r in key_universe([(a, "k"), (b, "k")], "k").collect()) == [1, 2, 3]
    pairs = pair_universe([a, b.union(spark.createDataFrame([(None, "z")], "k int, v string"))], ["k", "v"], "k")
    assert sorted(map(tuple, pairs.collect()), key=str) == sorted([(1, "x"), (2, "y"), (3, None)], key=str)
    diff = sorted((tuple(r) for r in reconcile(a, b).collect()), key=str)
    assert diff == [("only_in_a", 1, "x"), ("only_in_b", 3, None)]
    summary = {r.metric: r.value for r in reconcile_summary(a, b).collect()}
    assert summary == {"rows_a": 3, "rows_b": 2, "only_in_a": 1, "only_in_b": 1}


def test_star_helpers(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (9, 90)], "k int, v int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    out = sorted(tuple(r) for r in enrich(fact, dim, "k").collect())
    assert out == [(1, 10, "one"), (2, 20, "two"), (9, 90, None)]
    assert "hint" not in enrich(fact, dim, "k")._jdf.queryExecution().analyzed().toString().lower()   # the planner decides
    o = orphan_summary(fact, dim, ["k"]).first()
    assert (o.orphan_rows, o.orphan_keys) == (1, 1)
    nulls = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    dim_null = dim.union(spark.createDataFrame([(None, "none")], "k int, name string"))
    o = orphan_summary(nulls, dim_null, ["k"]).first()
    assert (o.orphan_rows, o.orphan_keys) == (2, 1)          # NULL child keys never match


def test_value_profile(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "c1 string, c2 string")
    got = sorted(map(tuple, value_profile(df, ["c1", "c2"]).collect()), key=str)
    assert got == sorted([("c1", "a", 2), ("c1", "b", 1), ("c2", "x", 2), ("c2", None, 1)], key=str)


def test_decode_join_never_multiplies_rows(spark):
    from strata.functions import decode_join
    fact = spark.createDataFrame([("1",), ("2",), ("9",), (None,)], "code string")
    lookup = spark.createDataFrame([("1", "Federal"), ("1", "Federal (dup)"), ("2", "Estadual")], "c string, l string")
    out = decode_join(fact, "code", lookup, "c", "l", "label")
    rows = sorted((tuple(r) for r in out.collect()), key=str)
    assert len(rows) == 4 and ("9", None) in rows and ("2", "Estadual") in rows
    assert ("1", "Federal") in rows                         # smallest label of a duplicated code


def test_schema_diff_and_materialize(spark, scratch):
    from strata.operators.reshape import schema_diff
    from strata.sources import materialize
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, 2.0)], "k bigint, w double")
    assert schema_diff(a, b) == {"only_in_a": ["v"], "only_in_b": ["w"], "type_changed": ["k"]}
    back = materialize(spark, a, f"{scratch}/mat")
    assert [tuple(r) for r in back.collect()] == [(1, "x")]


def test_except_all_of_a_hot_row(spark):
    from strata.operators import reshape
    a = spark.range(250_001).select(F.lit(1).alias("k"))
    b = spark.createDataFrame([(1,), (2,)], "k int")
    rows = reshape.reconcile(a, b, keep_duplicates=True).groupBy("side", "k").count().collect()
    assert sorted(map(tuple, rows)) == [("only_in_a", 1, 250_000), ("only_in_b", 2, 1)]


def test_compare_tables_on_common_columns(spark):
    from strata.operators.reshape import compare_tables
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "k int, v string, extra double")
    b = spark.createDataFrame([(1, "x"), (3, "z")], "k int, v string")
    r = compare_tables(a, b)
    assert r["schema"]["only_in_a"] == ["extra"]
    assert {x.metric: x.value for x in r["counts"].collect()} == {"rows_a": 2, "rows_b": 2, "only_in_a": 1, "only_in_b": 1}
    assert sorted(tuple(x) for x in r["rows"].collect()) == [("only_in_a", 2, "y"), ("only_in_b", 3, "z")]


def test_missing_columns_are_report_rows_and_a_gate(spark):
    df = spark.range(1).withColumn("extra", F.lit(1))
    rows = {r.column_name: (r.violations, r.severity) for r in Q.contract_report(df, ["id", "ano", "rede"]).collect()}
    assert rows == {"id": (0, "gate"), "ano": (1, "gate"), "rede": (1, "gate")}
    with pytest.raises(Q.QualityGateError, match="ano.*rede"):
        Q.require_columns(df, ["id", "ano", "rede"])
    assert Q.require_columns(df, ["id"]).count() == 1
