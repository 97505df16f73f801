"""Rendering helpers agree with Python's formatting."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.functions.scalar import fixed, percent, py_float_text, safe_ratio


VALUES = [0.0, -0.0, 0.03125, 2.675, 0.348485, 3750.0, 1e-05, 1.5e-05, 15000000.0, 0.125, 0.0275, -1.0,
          1 / 3, 0.18079096045197738, 1e16, 123456789.125, 0.1, 1e-300, 2.5e+300,
          1 / 300, 1 / 3000, -1 / 3000, 1 / 30000, 12345678901234567.0, 9999999.999, 1e7, 1.1e15 / 7, 999.5e12]


def _render(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [tuple(r) for r in df.select("x", fixed("x", 4), percent("x"), py_float_text("x")).collect()]


def test_fixed_percent_and_repr_match_python(spark):
    for x, f4, pct, text in _render(spark, VALUES):
        assert text == str(x), x
        if abs(x) < 1e12:  # metric range; beyond it the JVM prints decimal, not binary, digits
            assert f4 == f"{x:.4f}", x
            assert pct == f"{x:.2%}", x


@settings(max_examples=1, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e12, max_value=1e12), min_size=50,
                max_size=50))
def test_fixed_matches_python_on_random_values(spark, xs):
    for x, f4, pct, text in _render(spark, xs):
        assert text == str(x), x
        assert f4 == f"{x:.4f}", x
        assert pct == f"{x:.2%}", x


def test_safe_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a long, b long")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [0.0, 0.25]
