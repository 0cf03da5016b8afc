"""Hand-sized edge frames for the scalar rules (FIXTURES §5, SURVEY §7.3)."""

import math

from pyspark.sql import functions as F

from proplens.functions import scalar as X


def _col(spark, values, typ="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_coerce_numeric_text(spark):
    vals = ["abc", "inf", "NaN", "", " 12 ", "1,200", "1e3", "5d"]
    got = [r[0] for r in _col(spark, vals, "string").select(X.coerce_numeric("v")).collect()]
    assert got == [None, None, None, None, 12.0, None, 1000.0, None]


def test_safe_divide(spark):
    df = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (0.0, 0.0), (None, 2.0), (6.0, None),
                                (float("inf"), 2.0)], "n double, d double")
    got = [r[0] for r in df.select(X.safe_divide("n", "d")).collect()]
    assert got == [2.0, None, None, None, None, None]


def test_clip_log1p(spark):
    got = [r[0] for r in _col(spark, [None, -1.0, 0.0, math.e - 1]).select(X.log1p_clipped("v")).collect()]
    assert got[0] is None and got[1] == 0.0 and got[2] == 0.0 and abs(got[3] - 1.0) < 1e-12


def test_age_flags(spark):
    from proplens.operators.features import age_flags
    df = spark.createDataFrame([(None,), (-2.0,), (5.0,), (15.0,), (50.0,)], "PropertyAge double")
    got = [tuple(r) for r in age_flags(df).select("IsNewProperty", "IsRecentProperty", "IsOlderProperty").collect()]
    assert got == [(0, 0, 0), (1, 1, 0), (1, 1, 0), (0, 1, 0), (0, 0, 1)]


def test_bands_half_open(spark):
    df = _col(spark, [-1.0, 499999.99, 500000.0, 5000000.0, None, float("inf")])
    got = [r[0] for r in df.select(X.band_order("v")).collect()]
    assert got == [1, 1, 2, 5, None, None]


def test_slug_and_format(spark):
    df = spark.createDataFrame([("Gradient Boosting-Reference", 1234.5, -0.00001)], "m string, x double, r double")
    r = df.select(X.slug("m", "_prediction"), X.format_money("x"), X.format_ratio("r"),
                  X.format_percent(F.lit(12.345))).first()
    assert r[0] == "gradient_boosting_reference_prediction"
    assert r[1] == "$1,234.50"
    assert r[2] == "-0.0000"
    assert r[3] in ("12.35%", "12.34%")


def test_finite_or_null(spark):
    got = [r[0] for r in _col(spark, [float("nan"), float("inf"), -float("inf"), 1.5])
           .select(X.finite_or_null("v")).collect()]
    assert got == [None, None, None, 1.5]


def test_format_half_even_on_unrounded(spark):
    # format_number rounds half-even, as Python's formatting does: 0.125 -> 0.12
    df = spark.createDataFrame([(0.125, 1234567.891)], "a double, b double")
    r = df.select(X.format_ratio("a", 2), X.format_money("b"), X.format_percent("a", 2)).first()
    assert r[0] == "0.12" and r[1] == "$1,234,567.89" and r[2] == "0.12%"


def test_wide_projections_are_compiled_unless_the_session_says_otherwise(spark):
    from proplens.session import compiled_methods
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        compiled_methods(spark)
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "20000")
        compiled_methods(spark)
        assert spark.conf.get(name) == "20000"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
