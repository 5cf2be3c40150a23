"""Hand-made edge rows for the scalar rules (FIXTURES section 5)."""

import hashlib

from pyspark.sql import functions as F

from indistar.functions import scalars as S


def _one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_number_first_only(spark):
    rows = [("12.5%", None), ("1,234.5", None), ("1,234%", "7"), ("1,234%", ""), ("~", "3"),
            ("", None), (" 12 ", None), ("1d", None), ("1e3", None), ("2.5f", None),
            ("0x1A", None), ("nan", None)]
    got = _one(spark, rows, "v string, alt string",
               S.normalize_number(F.col("v"), F.col("alt")))
    assert got[:10] == [12.5, 1234.5, 7.0, None, 3.0, None, 12.0, None, 1000.0, None]
    assert got[10] is None
    assert got[11] != got[11]  # NaN parses, as in the reference engine


def test_number_strip_all(spark):
    got = _one(spark, [("1,234,567%",)], "v string", S.normalize_number(F.col("v"), strip="all"))
    assert got == [1234567.0]
    first = _one(spark, [("1,234,567%",)], "v string", S.normalize_number(F.col("v")))
    assert first == [None]


def test_number_column_type_branch(spark):
    df = spark.createDataFrame([(1.5, "2,5")], "d double, s string")
    row = df.select(S.number_column(df, "d").alias("a"), S.number_column(df, "s").alias("b")).first()
    assert row.a == 1.5 and row.b == 25.0


def test_point(spark):
    rows = [("POINT (-86.6 32.8)",), ("",), (None,), ("x",)]
    df = spark.createDataFrame(rows, "g string")
    got = [tuple(r) for r in df.select(S.point_lon("g"), S.point_lat("g")).collect()]
    assert got == [(-86.6, 32.8), (None, None), (None, None), (None, None)]


def test_blank_and_default(spark):
    df = spark.createDataFrame([("",), (None,), ("a",)], "s string")
    got = [tuple(r) for r in df.select(S.blank_to_null("s"), S.default_label("s")).collect()]
    assert got == [(None, "Overall"), (None, "Overall"), ("a", "a")]


def test_surrogate_key_nulls_as_empty(spark):
    df = spark.createDataFrame([(None, 2019), ("", 2019)], "a string, y int")
    got = [r[0] for r in df.select(S.surrogate_key("a", "y")).collect()]
    expected = hashlib.md5(b"-2019").hexdigest()
    assert got == [expected, expected]


def test_indicator_propagates_null(spark):
    df = spark.createDataFrame([("T", "Q"), (None, "Q")], "t string, q string")
    got = [r[0] for r in df.select(S.indicator("t", "q")).collect()]
    assert got == ["T - Q", None]


def test_stable_round_tie_is_engine_independent(spark):
    # 0.125 -> 0.13 whatever the last-bit noise: both sides of the tie agree
    df = spark.createDataFrame([(0.125,), (0.12499999999999999,), (0.1250000000000001,)], "x double")
    got = [r[0] for r in df.select(S.stable_round("x")).collect()]
    assert got == [0.13, 0.13, 0.13]


def test_strict_integer_cast_raises_on_fraction(spark):
    """Year text must be integral; ANSI casting raises instead of rounding."""
    import pytest
    from pyspark.errors import PySparkException

    from indistar.plans import staging
    from indistar.sources.contract import RAW_COLUMNS

    row = {c: "" for c in RAW_COLUMNS}
    row.update({"YearStart": "2.6", "YearEnd": "2019", "DataValue": "1"})
    df = spark.createDataFrame([tuple(row[c] for c in RAW_COLUMNS)],
                               ", ".join(f"{c} string" for c in RAW_COLUMNS))
    with pytest.raises(PySparkException):
        staging.clean(df).collect()
