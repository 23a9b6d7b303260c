"""Column functions against the edge semantics listed in SURVEY §1.5."""
import math


from strata.functions import (
    any_decrease, attained, cast_columns, classify_period, decode, decode_flags, gap, json_int, json_scalar,
    mean_of_cents, normalize_label, normalized_text, pad_id_guarded, pad_id_unguarded, reverse_gap,
    text_to_double, text_to_int, trimmed_text, upper_code,
)
from strata.functions.domains import NETWORK_LABELS


def one(spark, data, schema, expr):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_normalized_text_empty_to_null_and_tabs_kept(spark):
    got = one(spark, [(" a ",), ("",), ("   ",), ("\tb",), (None,)], "x string", normalized_text("x"))
    assert got == ["a", None, None, "\tb", None]
    got = one(spark, [("",), ("  ",)], "x string", trimmed_text("x"))
    assert got == ["", ""]


def test_upper_code(spark):
    assert one(spark, [(" ab ",), ("",)], "x string", upper_code("x")) == ["AB", None]


def test_guarded_padding(spark):
    data = [("12",), ("1234567",), ("123456789",), ("AB",), ("",), (None,)]
    got = one(spark, data, "x string", pad_id_guarded(normalized_text("x")))
    assert got == ["0000012", "1234567", "123456789", "AB", None, None]


def test_unguarded_padding_truncates(spark):
    data = [("12",), ("123456789",), ("AB",), ("",), (" 3 ",)]
    assert one(spark, data, "x string", pad_id_unguarded("x")) == ["0000012", "1234567", "00000AB", "0000000", "0000003"]
    # stream form: no trim, so spaces are padded/truncated as characters
    assert one(spark, [(" 3 ",)], "x string", pad_id_unguarded("x", trim=False)) == ["0000 3 "]


def test_decode_unknown_and_null(spark):
    got = one(spark, [("1",), ("5",), ("9",), (None,)], "x string", decode("x"))
    assert got == ["Federal", NETWORK_LABELS["5"], None, None]


def test_label_normaliser(spark):
    data = [("pública",), (" PUBLICA ",), ("p�blica",), ("pãºblica",), ("",), ("municipal",),
            ("pública (estadual e municipal)",), ("Desconhecida",), (None,)]
    got = one(spark, data, "x string", normalize_label("x"))
    assert got == ["Pública", "Pública", "Pública", "Pública", None, "Municipal",
                   "Pública (estadual E Municipal)", "Desconhecida", None]


def test_flag_decode_keeps_code(spark):
    df = spark.createDataFrame([(1, "1"), (0, "0"), (2, " 1 "), (None, None)], "a int, b string")
    out = decode_flags(df, ["a", "b"])
    assert out.columns == ["a_id", "b_id", "a", "b"]
    rows = [tuple(r) for r in out.collect()]
    assert rows == [(1, 1, True, True), (0, 0, False, False), (2, 1, None, True), (None, None, None, None)]


def test_guarded_casts(spark):
    ints = one(spark, [(" 12 ",), ("1.7",), ("-3.9",), (" 4. ",), ("2.0",), ("abc",), ("",), ("-3",), ("3000000000",)], "x string", text_to_int("x"))
    assert ints == [12, 1, -3, 4, 2, None, None, -3, None]   # fractions are cut off, as without ANSI mode
    dbl = one(spark, [(" 1.5 ",), ("1e3",), ("1d",), (".5",), ("-Infinity",), ("n/a",)], "x string", text_to_double("x"))
    assert dbl == [1.5, 1000.0, None, 0.5, float("-inf"), None]
    assert math.isnan(one(spark, [("NaN",)], "x string", text_to_double("x"))[0])


def test_cast_columns_is_type_aware(spark):
    df = spark.createDataFrame([(3.0, "4", "x")], "a double, b string, c string")
    row = cast_columns(df, {"a": "int", "b": "int", "c": "double"}).first()
    assert (row.a, row.b, row.c) == (3, 4, None)


def test_json_scalar_semantics(spark):
    data = [('{"k": 5}',), ('{"k": {"a": 1}}',), ('{"k": [1]}',), ("not json",), ('{"k": "x"}',)]
    assert one(spark, data, "j string", json_scalar("j", "$.k")) == ["5", None, None, None, "x"]
    assert one(spark, data, "j string", json_int("j", "$.k")) == [5, None, None, None, None]


def test_gap_rounding_half_up_and_nulls(spark):
    df = spark.createDataFrame([(1.005, 0.0), (50.0, None), (70.0, 72.5)], "a double, t double")
    rows = df.select(gap("a", "t"), attained("a", "t"), reverse_gap("a", "t")).collect()
    assert tuple(rows[0]) == (1.01, True, -1.01)
    assert tuple(rows[1]) == (None, None, None)
    assert tuple(rows[2]) == (-2.5, False, 2.5)


def test_any_decrease_three_valued(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (3.0, 2.0, 1.0), (3.0, None, 1.0), (1.0, None, 2.0)],
                               "a double, b double, c double")
    assert [r[0] for r in df.select(any_decrease(["a", "b", "c"])).collect()] == [False, True, None, None]


def test_period_and_mean_of_cents(spark):
    assert one(spark, [(2024,), (2025,)], "y int", classify_period("y")) == ["realizado", "projetado"]
    df = spark.createDataFrame([(101, 2), (100, 3), (0, 0)], "s long, n long")
    got = [r[0] for r in df.select(mean_of_cents("s", "n")).collect()]
    assert got[0] == 0.51 and got[1] == 0.33 and got[2] is None
    assert not any(isinstance(g, float) and math.isnan(g) for g in got)
