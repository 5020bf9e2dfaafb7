"""Literal edge cases of the column builders, with ANSI mode off and on."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mdmspark.functions import (
    bounded_text,
    chip_flag,
    clean_money,
    clean_text,
    gender_code,
    is_blank,
    location_type,
    mcc_is_valid,
    normalize_mcc,
    parse_flexible_date,
    title_text,
    too_long,
    transaction_method,
    unparseable_date,
    upper_text,
)


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_money(spark, ansi):
    vals = ["$12,345.67", "$-77.00", "", "N/A", "12-34", "1.005", "($50.25)", "1.234,56",
            "12345678901234567890", None, " 42 "]
    got = one_col(spark, vals, clean_money)
    assert got == [Decimal("12345.67"), Decimal("-77.00"), None, None, None, Decimal("1.01"),
                   Decimal("50.25"), Decimal("1.23"), None, None, Decimal("42.00")]


def test_clean_money_numeric_source(spark, ansi):
    from pyspark.sql.types import DoubleType
    df = spark.createDataFrame([(1.0e7,), (12.345,), (None,)], "v double")
    got = [r[0] for r in df.select(clean_money(F.col("v"), DoubleType())).collect()]
    assert got == [Decimal("10000000.00"), Decimal("12.35"), None]


def test_integer_casts_do_not_truncate(spark, ansi):
    df = spark.createDataFrame([("12.7",), ("3000000000",), ("42",)], "v string")
    got = [r[0] for r in df.select(F.col("v").try_cast("int")).collect()]
    assert got == [None, None, 42]


@pytest.mark.parametrize("text,expected", [
    ("09/2025", dt.date(2025, 9, 1)),
    ("09/25", dt.date(2025, 9, 1)),
    ("2025-09", dt.date(2025, 9, 1)),
    ("03/04/2020", dt.date(2020, 3, 4)),
    ("25/12/2020", dt.date(2020, 12, 25)),
    (" 2020-01-05 ", dt.date(2020, 1, 5)),
    ("09/99", dt.date(2099, 9, 1)),
    ("01/09/99", None),
    ("13/2025", None),
    ("2020-02-30", None),
    ("1/5/2020", None),
    ("2020-1-5", None),
    ("2020-01-05 00:00:00", None),
    ("", None),
    ("garbage", None),
    (None, None),
])
def test_flexible_date(spark, ansi, text, expected):
    assert one_col(spark, [text], parse_flexible_date) == [expected]


def test_month_end(spark, ansi):
    got = one_col(spark, ["2024-02-01", "02/2023", "12/24"], lambda c: parse_flexible_date(c, end_of_month=True))
    assert got == [dt.date(2024, 2, 29), dt.date(2023, 2, 28), dt.date(2024, 12, 31)]


def test_unparseable_date(spark, ansi):
    got = one_col(spark, ["", None, "garbage", "2024-01-01", "  "], unparseable_date)
    assert got == [False, False, True, False, False]


def test_mcc(spark, ansi):
    vals = ["742", " ", None, "12345", "ab", "742.0", " 5411 ", "0"]
    assert one_col(spark, vals, normalize_mcc) == ["0742", None, None, "12345", "ab", "742.0", "5411", "0000"]
    assert one_col(spark, vals, mcc_is_valid) == [True, False, False, False, False, False, True, True]


def test_mcc_from_integer(spark, ansi):
    assert one_col(spark, [742, None], normalize_mcc, "bigint") == ["0742", None]


def test_location_type(spark, ansi):
    rows = [(None, "Paris"), ("Chip Transaction", None), ("Chip Transaction", " "), ("Swipe Transaction", "Paris"),
            (None, " online "), ("Chip Transaction", "Online"), ("online transaction", "x"),
            ("Online Transaction", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, u string, c string")
    got = [r[0] for r in df.orderBy("i").select(location_type(F.col("u"), F.col("c"))).collect()]
    assert got == ["UNKNOWN", "UNKNOWN", "UNKNOWN", "PHYSICAL", "ONLINE", "ONLINE", "UNKNOWN", "ONLINE"]


def test_transaction_method(spark, ansi):
    vals = ["Chip Transaction", "Swipe Transaction", "Online Transaction", "chip transaction", " Chip Transaction", None]
    assert one_col(spark, vals, transaction_method) == ["CHIP", "SWIPE", "ONLINE", "UNKNOWN", "UNKNOWN", "UNKNOWN"]


def test_gender(spark, ansi):
    vals = [" male ", "FEMALE", "Female", "", None, "non-binary"]
    assert one_col(spark, vals, gender_code) == [1, 0, 0, None, None, None]
    assert one_col(spark, vals, title_text) == ["Male", "Female", "Female", "", None, "Non-binary"]


def test_chip_flag(spark, ansi):
    vals = ["YES", " y", "True", "1", "no", "N", "FALSE", "0", "maybe", None]
    assert one_col(spark, vals, chip_flag) == [1, 1, 1, 1, 0, 0, 0, 0, None, None]


def test_text(spark, ansi):
    vals = ["  a b  ", "\tx\n", None]
    assert one_col(spark, vals, clean_text) == ["a b", "\tx\n", None]
    assert one_col(spark, [" visa "], upper_text) == ["VISA"]
    assert one_col(spark, ["x" * 1005, " ab "], bounded_text) == ["x" * 1000, "ab"]
    assert one_col(spark, ["x" * 1001, "x" * 1000, None], too_long) == [True, False, False]
    assert one_col(spark, [None, "", "  ", "a"], is_blank) == [True, True, True, False]
