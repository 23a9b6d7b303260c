"""Property tests: operators against brute force in plain Python on random rows."""
from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.dedup import keep_one_per_key
from strata.operators.reshape import reconcile, unpivot_columns

small_int = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
small_txt = st.one_of(st.none(), st.sampled_from(["", "a", "b", "ab"]))
rows_strategy = st.lists(st.tuples(small_int, small_int, small_txt), min_size=0, max_size=30)
SCHEMA = "k int, a int, b string"
SETTINGS = settings(max_examples=12, deadline=None)


def nulls_last(v):
    return (v is None, v if v is not None else 0)


@SETTINGS
@given(rows=rows_strategy, parts=st.integers(min_value=1, max_value=4))
def test_dedup_matches_brute_force(spark, rows, parts):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = sorted((tuple(r) for r in keep_one_per_key(df, ["k"]).collect()), key=str)
    best = {}
    for r in rows:
        key = (nulls_last(r[1]), nulls_last(r[2]))
        if r[0] not in best or key < best[r[0]][0]:
            best[r[0]] = (key, r)
    assert got == sorted((v[1] for v in best.values()), key=str)


@SETTINGS
@given(rows=rows_strategy)
def test_one_pass_report_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    checks = [Q.row_count(), *Q.nulls("k", "b"), Q.outside_domain("b", ["a", "b"]),
              Q.out_of_range("a", -1.0, 1.0, nan=False), Q.rule("k_gt_a", "k,a", F.col("k") > F.col("a"))]
    got = [r.violations for r in Q.run_checks(df, checks).collect()]
    expected = [
        len(rows),
        sum(r[0] is None for r in rows),
        sum(r[2] is None for r in rows),
        sum(r[2] is not None and r[2] not in ("a", "b") for r in rows),
        sum(r[1] is not None and (r[1] < -1 or r[1] > 1) for r in rows),
        sum(r[0] is not None and r[1] is not None and r[0] > r[1] for r in rows),
    ]
    assert got == expected


@SETTINGS
@given(rows=rows_strategy)
def test_unpivot_keeps_exactly_the_non_null_cells(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    long = unpivot_columns(df, [], {"k": "k", "a": "a"}, "name", "value")
    assert long.count() == sum((r[0] is not None) + (r[1] is not None) for r in rows)


@SETTINGS
@given(left=rows_strategy, right=rows_strategy)
def test_reconcile_is_set_difference(spark, left, right):
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    got = Counter(tuple(r) for r in reconcile(a, b).collect())
    expected = Counter([("only_in_a", *r) for r in set(left) - set(right)] +
                       [("only_in_b", *r) for r in set(right) - set(left)])
    assert got == expected


@SETTINGS
@given(left=rows_strategy, right=rows_strategy)
def test_reconcile_all_is_multiset_difference(spark, left, right):
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    got = Counter(tuple(r) for r in reconcile(a, b, keep_duplicates=True).collect())
    ca, cb = Counter(left), Counter(right)
    expected = Counter({("only_in_a", *r): n for r, n in (ca - cb).items()})
    expected.update({("only_in_b", *r): n for r, n in (cb - ca).items()})
    assert got == expected


id_text = st.one_of(st.none(), st.text(alphabet="0123456789AB \t", max_size=10))


def _lpad7(t):
    return t[:7] if len(t) >= 7 else "0" * (7 - len(t)) + t


@SETTINGS
@given(values=st.lists(id_text, max_size=25))
def test_id_paddings_match_their_rules(spark, values):
    import re
    from strata.functions import normalized_text, pad_id_guarded, pad_id_unguarded
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [tuple(r) for r in df.select(pad_id_guarded(normalized_text("x")), pad_id_unguarded("x")).collect()]
    expected = []
    for v in values:
        if v is None:
            expected.append((None, None))
            continue
        t = v.strip(" ")                       # trim removes spaces only
        n = t or None                          # '' -> NULL before the guarded pad
        guarded = _lpad7(n) if n is not None and re.fullmatch(r"[0-9]{1,7}", n) else n
        expected.append((guarded, _lpad7(t)))
    assert got == expected


label_text = st.one_of(st.none(), st.sampled_from(["pública", " PUBLICA ", "p�blica"]),
                       st.text(alphabet="abAB á()", max_size=12))


def _initcap(s):
    out, prev = [], " "
    for ch in s.lower():
        out.append(ch.upper() if prev == " " else ch)
        prev = ch
    return "".join(out)


@SETTINGS
@given(values=st.lists(label_text, max_size=25))
def test_label_normaliser_matches_its_rules(spark, values):
    from strata.functions import normalize_label
    from strata.functions.domains import PUBLIC_LABEL, PUBLIC_LABEL_VARIANTS
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(normalize_label("x")).collect()]
    expected = []
    for v in values:
        if v is None:
            expected.append(None)
            continue
        t = v.strip(" ")
        if t.lower() in PUBLIC_LABEL_VARIANTS:
            expected.append(PUBLIC_LABEL)
        elif t == "":
            expected.append(None)
        else:
            expected.append(_initcap(t))
    assert got == expected


num_text = st.one_of(st.none(), st.sampled_from(["NaN", "inf", "-Infinity", "1e3", ".5", "1.", "+7", "99999999999"]),
                     st.text(alphabet="0123456789.-+e ", max_size=8))


@SETTINGS
@given(values=st.lists(num_text, max_size=25))
def test_guarded_casts_match_their_rules(spark, values):
    import math
    import re
    from strata.functions import text_to_double, text_to_int
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [tuple(r) for r in df.select(text_to_int("x"), text_to_double("x")).collect()]
    dec = re.compile(r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?(?i:inf|infinity)|(?i:nan)")
    for v, (i, d) in zip(values, got):
        t = None if v is None else v.strip(" ")
        exp_i = int(t.split(".")[0]) if t is not None and re.fullmatch(r"[+-]?[0-9]+(\.[0-9]*)?", t) else None
        if exp_i is not None and not (-2**31 <= exp_i < 2**31):
            exp_i = None                                   # out of int range -> NULL, never an error
        assert i == exp_i, (v, i)
        exp_d = float(t) if t is not None and dec.fullmatch(t) else None
        if exp_d is not None and math.isnan(exp_d):
            assert d is not None and math.isnan(d), (v, d)
        else:
            assert d == exp_d, (v, d)


@SETTINGS
@given(rows=rows_strategy)
def test_grouped_checks_match_brute_force(spark, rows):
    from strata.operators.profile import value_profile
    df = spark.createDataFrame(rows, SCHEMA)
    # Q2: keys with more than one row (NULL keys group together)
    per_key = Counter(r[0] for r in rows)
    s = Q.duplicate_summary(df, ["k"]).first()
    dups = {k: n for k, n in per_key.items() if n > 1}
    assert (s.dup_keys, s.dup_rows, s.surplus_rows) == (len(dups), sum(dups.values()), sum(n - 1 for n in dups.values()))
    # Q16: k -> distinct non-NULL b values, NULL k skipped
    fd = {(r.k, r.n_values) for r in Q.functional_dependency(df, ["k"], "b", skip_null=["k"]).collect()}
    values = {}
    for k, _, b in rows:
        if k is not None and b is not None:
            values.setdefault(k, set()).add(b)
    assert fd == {(k, len(v)) for k, v in values.items() if len(v) > 1}
    # Q25: value frequencies of every listed column, NULL included
    prof = Counter({(r.column_name, r.value): r.n for r in value_profile(df, ["a", "b"]).collect()})
    expected = Counter([("a", None if r[1] is None else str(r[1])) for r in rows] + [("b", r[2]) for r in rows])
    assert prof == expected


@SETTINGS
@given(rows=rows_strategy)
def test_observed_report_equals_one_pass_report(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    checks = [Q.row_count(), *Q.nulls("k", "a", "b"), Q.outside_domain("b", ["a"]),
              Q.out_of_range("a", 0.0, 2.0, nan=False)]
    separate = sorted(map(tuple, Q.run_checks(df, checks).collect()), key=str)
    observed, report = Q.observe_checks(df, checks)
    observed.write.format("noop").mode("overwrite").save()      # the "write" that carries the checks
    assert sorted(map(tuple, report(spark).collect()), key=str) == separate
