"""Cleaner and conformer traps on literal rows."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from vigil.functions import clean, conform


def _one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [r[0] for r in df.select(fn(F.col("c"))).collect()]


def test_nullish_parity_keeps_na(spark):
    got = _one(spark, ["NA", "#N/A", "N/A", "null", "-", " unknown ", "None", "", None, "  a   b "], clean.text)
    assert got == ["NA", "#N/A", None, None, None, None, None, None, None, "a b"]


def test_nullish_strict(spark):
    got = _one(spark, ["NA", "#N/A", "x"], lambda c: clean.text(c, clean.NULLISH_STRICT))
    assert got == [None, None, "x"]


def test_money(spark):
    got = _one(spark, ["1,234.50", "RM99.00", "(45.00)", "usd 12.30 ", "-", "abc", "MYR 7", None], clean.money)
    assert got == [Decimal("1234.50"), Decimal("99.00"), Decimal("-45.00"), Decimal("12.30"), None, None,
                   Decimal("7.00"), None]


def test_money_keeps_precision(spark):
    df = spark.createDataFrame([("(1.00)",)], "c string").select(clean.money("c").alias("m"))
    assert df.schema["m"].dataType.simpleString() == "decimal(18,2)"


def test_dates(spark):
    got = _one(spark, ["2024-01-05", "2024-1-5", "5/3/2024", "03/25/2024", "5-Mar-75", "5-Mar-50",
                       "05.03.2024", "9999-12-31", "1970-01-01", "unknown", "garbage"], clean.date_multi)
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 3, 5), dt.date(2024, 3, 25),
                   dt.date(1975, 3, 5), dt.date(2050, 3, 5), dt.date(2024, 3, 5), None, None, None, None]


def test_four_digit_year_not_pivoted(spark):
    assert _one(spark, ["2075-01-01"], clean.date_multi) == [dt.date(2075, 1, 1)]


def test_timestamps_offset_dropped_and_epoch(spark):
    got = _one(spark, ["2024-01-05 23:33:00", "2024-01-05T23:33:00+08:00", "05/01/2024 23:33",
                       "1704067200", "2024-01-05 23:33:00.000", "N/A"], clean.timestamp_multi)
    assert got == [dt.datetime(2024, 1, 5, 23, 33), dt.datetime(2024, 1, 5, 23, 33), dt.datetime(2024, 1, 5, 23, 33),
                   dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 5, 23, 33), None]


def test_flags_and_patterns(spark):
    assert _one(spark, ["Y", "yes", "0", "F", "maybe", None], clean.flag) == [True, True, False, False, None, None]
    assert _one(spark, [" 4829 ", "541", "N/A"], lambda c: clean.matching(c, r"^[0-9]{4}$")) == ["4829", None, None]
    assert _one(spark, ["fs 12.5%", None], clean.scrape_number) == [12.5, None]


def test_conformers(spark):
    assert _one(spark, [" dr ", "Credit", "x"], conform.txn_type) == ["DEBIT", "CREDIT", None]
    assert _one(spark, ["Malaysia", "458", "SG"], conform.country) == ["MY", "MY", None]
    assert _one(spark, ["00", "approved", "NA", "", "51"], conform.auth_approved) == [True, True, False, None, False]
    assert _one(spark, ["male", "2", "x"], conform.gender) == ["M", "F", None]
    assert _one(spark, ["IB", "call center", "api"], conform.channel) == ["INTERNET", "CALL_CENTRE", "OTHER"]
