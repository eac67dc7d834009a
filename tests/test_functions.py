"""Scalar functions on the literal fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from carelake.functions import coerce as C
from carelake.functions import dates as D
from carelake.functions import text as X
from carelake.functions.labels import bins, label


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_integer_coercion(spark):
    vals = ["7", " 7 ", "2.9", "-2.9", "x", None, "nan"]
    assert col_values(spark, vals, C.coerce_int) == [7, 7, 2, -2, 0, 0, 0]


def test_float_coercion(spark):
    assert col_values(spark, ["1e3", "12,5", "inf", " 3.5 "], C.coerce_float) == [1000.0, 0.0, 0.0, 3.5]


def test_locale_number(spark):
    vals = ["1.234,5", "", "abc"]
    assert col_values(spark, vals, lambda c: C.locale_number(c, as_int=True)) == [1234, 0, 0]
    assert col_values(spark, vals, C.locale_number) == [1234.5, 0.0, 0.0]


def test_percent_modes(spark):
    vals = ["85,5%", "", "n/a"]
    assert col_values(spark, vals, lambda c: C.percent(c, "zero")) == [0.855, 0.0, None]
    assert col_values(spark, vals, lambda c: C.percent(c, "null")) == [0.855, None, None]
    bad = col_values(spark, vals, lambda c: C.bad_value(c, C.percent(c, "null")))
    assert sum(bad) == 1


def test_strip_dot_zero(spark):
    assert col_values(spark, ["12.0", "10.05"], C.strip_dot_zero) == ["12", "10.05"]


def test_clamp_and_nulls(spark):
    assert col_values(spark, [">18.50", "<0.5", "MEMO"], C.clamp_censored) == [18.5, 0.5, None]
    assert col_values(spark, ["nan", "None", "null", "", None, "nul", "42"],
                      lambda c: C.null_literals(c, "")) == ["", "", "", "", "", "", "42"]


def test_int_if_digits(spark):
    assert col_values(spark, ["123", "12a", None], C.int_if_digits) == [123, None, None]


def test_multi_format_dates(spark):
    vals = ["31/01/2024 10:00:00", "31/01/2024", "2024-01-31", "junk"]
    got = col_values(spark, vals, lambda c: C.coerce_date(c, "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "yyyy-MM-dd"))
    assert got == [dt.date(2024, 1, 31)] * 3 + [None]


def test_age_years_and_months(spark):
    df = spark.createDataFrame([(dt.date(2000, 2, 29), dt.date(2023, 2, 28)),
                                (dt.date(2024, 1, 31), dt.date(2024, 2, 1))], "b date, o date")
    r = df.select(D.age_years("b", "o").alias("y"), D.age_months("b", "o").alias("m")).collect()
    assert r[0]["y"] == 22
    assert r[1]["m"] == 1


def test_full_months_and_mid_month(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 29))], "a date, b date")
    r = df.select(D.full_months("a", "b").alias("m"), D.mid_month("b").alias("k")).first()
    assert r["m"] == 0 and r["k"] == dt.date(2024, 2, 15)


def test_bins(spark):
    got = col_values(spark, [0, 5, 6, 14, 15, 59, 60, -1],
                     lambda c: bins(c, [0, 5, 14, 44, 59, float("inf")], list("ABCDE")), "int")
    assert got == ["A", "A", "B", "B", "C", "D", "E", None]


def test_label_modes(spark):
    m = {"F": "Femenino", "M": "Masculino"}
    assert col_values(spark, ["F", "X"], lambda c: label(c, m)) == ["Femenino", None]
    assert col_values(spark, ["F", "X"], lambda c: label(c, m, keep=True)) == ["Femenino", "X"]


def test_text_helpers(spark):
    assert col_values(spark, ["ÁRBOL ÑANDÚ"], X.accent_fold) == ["ARBOL NANDU"]
    assert col_values(spark, ["0 days 08:30:00"], X.time_of_day) == ["08:30:00"]
    assert col_values(spark, ["abc-123-45", "none"], X.first_dash_number) == ["123", None]
    assert col_values(spark, ["45 Años"], lambda c: X.strip_unit(c, "Años")) == ["45"]


def test_calendar_windows():
    run = dt.date(2024, 1, 17)
    assert D.prev_week(run, legacy=True) == (dt.date(2024, 1, 7), dt.date(2024, 1, 14))
    assert D.prev_week(run) == (dt.date(2024, 1, 8), dt.date(2024, 1, 14))
    assert D.fortnight(dt.date(2024, 3, 16)) == (dt.date(2024, 3, 1), dt.date(2024, 3, 15))
    assert D.fortnight(dt.date(2024, 3, 1)) == (dt.date(2024, 2, 16), dt.date(2024, 2, 29))
    assert D.fortnight(dt.date(2024, 3, 10)) is None
    assert D.prev_month(dt.date(2024, 3, 10)) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert D.lagged_month(dt.date(2024, 3, 10), 15) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert D.period_path("x/{year}/{month_name}/f_{yyyymm}", dt.date(2024, 3, 1)) == "x/2024/marzo/f_202403"
