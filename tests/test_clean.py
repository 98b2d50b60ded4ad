"""Dirty-value matrix for the Column cleaning functions (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import clean

from row_helpers import rows


def one(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_trim_keeps_tabs(spark):
    assert one(spark, ["  a  ", "\tb\t", None], clean.trim) == ["a", "\tb\t", None]


def test_norm_cases(spark):
    assert one(spark, [" Ab "], lambda c: clean.norm(c, "upper")) == ["AB"]
    assert one(spark, [" Ab "], lambda c: clean.norm(c, "lower")) == ["ab"]
    with pytest.raises(ValueError):
        clean.norm(F.col("v"), "title")


def test_blank_to_null(spark):
    assert one(spark, ["   ", "", " Court ", None], clean.blank_to_null) == [None, None, "Court", None]


def test_financial_token_policy(spark):
    vals = ["", " null ", "N/A", "na", "unknown", " abc "]
    got = one(spark, vals, lambda c: clean.tokens_to_null(c, clean.FINANCIAL_NULL_TOKENS, "upper"))
    assert got == [None, None, None, "NA", "UNKNOWN", "ABC"]


def test_market_token_policy(spark):
    vals = ["", "NULL", " n/a", "NA", "unknown", " MixedCase "]
    got = one(spark, vals, lambda c: clean.tokens_to_null(c, clean.MARKET_NULL_TOKENS, "lower"))
    assert got == [None, None, None, None, "unknown", "mixedcase"]
    keep = one(spark, vals, lambda c: clean.tokens_to_null(c, clean.MARKET_NULL_TOKENS, None))
    assert keep == [None, None, None, None, "unknown", "MixedCase"]


def test_placeholders_keep_original_untrimmed(spark):
    df = spark.createDataFrame([(1, " Unknown ", " keep me "), (2, "--", "?"), (3, "ok", None)],
                               "id int, a string, b string")
    out = rows(clean.placeholders_to_null(df).orderBy("id"))
    assert out == [(1, None, " keep me "), (2, None, None), (3, "ok", None)]


def test_strict_cast_fails_and_tolerant_is_null(spark):
    df = spark.createDataFrame([("12",), ("abc",)], "v string")
    assert [r[0] for r in df.select(clean.cast("v", "int")).collect()] == [12, None]
    with pytest.raises(Exception):
        df.select(clean.cast("v", "int", on_error="fail")).collect()


def test_money_no_comma_removal(spark):
    got = one(spark, [" 1234.50 ", "1,234.50", "N/A", "", "-3", "1.0e7"], clean.money)
    assert got == [Decimal("1234.50"), None, None, None, Decimal("-3.00"), Decimal("10000000.00")]


def test_grouped_number_market(spark):
    vals = ["1,234.50", "1.0e7", "abc", "-1", "12345678901234567890", "n/a"]
    got = one(spark, vals, lambda c: clean.number(c, "decimal(18,2)"))
    assert got == [Decimal("1234.50"), Decimal("10000000.00"), None, Decimal("-1.00"), None, None]


def test_integer_parse(spark):
    assert one(spark, ["12", "12.0", "1,2"], lambda c: clean.number(c, "bigint")) == [12, None, 12]
    assert one(spark, ["12", "12.0", "1,2"], lambda c: clean.number(c, "int", strip=None)) == [12, None, None]
    assert one(spark, ["12.0"], lambda c: clean.number(c, "bigint", lenient_int=True)) == [12]


def test_to_decimal_equals_bare_try_cast(spark):
    vals = ["1", " 2.50 ", "-0.005", "1e3", "1,0", "abc", "", ".5", "5.", "+7", "--1", "1e", None,
            "١٢", "NaN", "Infinity", "0x10", "1 000"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    a = [r[0] for r in df.select(clean.to_decimal(F.col("v"), "decimal(18,2)")).collect()]
    b = [r[0] for r in df.select(F.col("v").try_cast("decimal(18,2)")).collect()]
    assert a == b


def test_boolean_vocabulary(spark):
    vals = ["true", "1", "Yes", "y", "t", "false", "0", "no", "N", "f", "maybe", "n/a"]
    assert one(spark, vals, clean.boolean) == [True] * 5 + [False] * 5 + [None, None]


def test_timestamp_forms(spark):
    vals = ["2024-01-02T03:04:05", "2024-01-02 03:04:05", "2024-01-02", "2024-01-02T03:04:05Z", "text"]
    got = one(spark, vals, clean.timestamp)
    assert got[:3] == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2)]
    assert got[3:] == [None, None]


def test_cpi_label(spark):
    df = spark.createDataFrame([("CPI-U 2021 (270.97)",), ("CPI-U 2021",), ("(270.97)",), (None,)], "v string")
    y, v = clean.cpi("v")
    assert rows(df.select(y, v)) == [(2021, Decimal("270.97")), (2021, None), (None, Decimal("270.97")),
                                     (None, None)]


def test_safe_ratio_and_flags(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, None), (10.0, 4.0)], "n double, d double")
    assert [r[0] for r in df.select(clean.safe_ratio("n", "d", 2)).collect()] == [None, None, 2.5]
    df2 = spark.createDataFrame([(1.0,), (0.0,), (None,), (-2.0,)], "v double")
    assert [r[0] for r in df2.select(clean.flag_positive("v")).collect()] == [1, 0, 0, 0]


def test_cleaning_is_idempotent(spark):
    vals = [" a ", "NULL", "n/a", "x"]
    once = one(spark, vals, lambda c: clean.tokens_to_null(c, clean.MARKET_NULL_TOKENS, "lower"))
    twice = one(spark, once, lambda c: clean.tokens_to_null(c, clean.MARKET_NULL_TOKENS, "lower"))
    assert once == twice
