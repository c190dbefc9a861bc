from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal as D

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netdays.functions import codes, dates, keys, money, terms


def column(spark, values, kind, expression):
    """The expression over column ``x``, in the order of the values."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_normalize_text(spark):
    got = column(spark, ["  Nairobi West-01 ", None, "", "Ärger/7"], "string", lambda x: keys.normalize_text(x))
    assert got == ["nairobiwest01", "", "", "rger7"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=30))
def test_normalize_text_keeps_only_plain_characters(spark, texts):
    expected = [re.sub("[^a-z0-9]", "", t.strip().lower()) for t in texts]
    assert column(spark, texts, "string", lambda x: keys.normalize_text(x)) == expected


def test_party_key(spark):
    rows = spark.createDataFrame(
        [("  Nairobi West-01 ", 7), (None, 7), ("A", None)], "s string, n bigint"
    )
    got = rows.select(keys.party_key(F.col("s"), F.col("n"))).collect()
    assert [r[0] for r in got] == ["nairobiwest01_7", "_7", "a_None"]


def test_invoice_key_is_null_when_a_part_is(spark):
    rows = spark.createDataFrame([(5, "A-1"), (None, "A-1"), (5, None)], "v bigint, n string")
    got = [r[0] for r in rows.select(keys.invoice_key(F.col("v"), F.col("n"))).collect()]
    assert got == ["5_A-1", None, None]


TERMS = ["30 Days Net", "30 days net", "Immediate", "7 Days Net", None, "Net 30 Days Net", "Days Net", "x 9", "123456 Days Net", "99999999999 Days Net"]


def test_terms(spark):
    assert column(spark, TERMS, "string", lambda x: terms.is_days_net(x)) == [
        True, True, False, True, False, True, True, False, True, True,
    ]
    assert column(spark, TERMS, "string", lambda x: terms.leading_days(x)) == [
        30, 30, None, 7, None, None, None, None, 123456, None,
    ]
    assert column(spark, TERMS, "string", lambda x: terms.first_digits(x)) == [
        30, 30, None, 7, None, 30, None, 9, 123456, None,
    ]
    assert column(spark, [7, 8, None], "int", lambda x: terms.long_enough(x)) == [False, True, None]
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 2_913_000), (dt.date(2024, 1, 1), 10_000), (None, 9), (dt.date(2024, 1, 1), 2**31 - 1)], "d date, n int")
    assert [r[0] for r in rows.select(terms.has_due_date(F.col("d"), F.col("n"))).collect()] == [True, True, True, False]


def test_date_texts(spark):
    days = [dt.date(2024, 12, 31), None]
    assert column(spark, days, "date", lambda x: dates.day_month_year(x)) == ["31-12-2024", None]
    assert column(spark, days, "date", lambda x: dates.day_mon_year(x)) == ["31-DEC-2024", None]
    texts = ["31-12-2024", "2024-12-31", None]
    assert column(spark, texts, "string", lambda x: dates.parse_day_month_year(x)) == [days[0], None, None]


def test_lookback_clamps_to_the_month_end(spark):
    got = column(spark, [dt.date(2025, 4, 30), dt.date(2025, 12, 31)], "date", lambda x: dates.lookback_start(x))
    assert got == [dt.date(2025, 2, 28), dt.date(2025, 10, 31)]


def test_windows_take_whole_days(spark):
    a, b = dt.date(2024, 1, 1), dt.date(2024, 1, 3)
    times = [
        dt.datetime(2023, 12, 31, 23), dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 9),
        dt.datetime(2024, 1, 3, 23), dt.datetime(2024, 1, 4),
    ]
    kind = "timestamp_ntz"
    assert column(spark, times, kind, lambda x: dates.on_or_after(x, a)) == [False, True, True, True, True]
    assert column(spark, times, kind, lambda x: dates.in_closed_window(x, a, b)) == [False, True, True, True, False]
    assert column(spark, times, kind, lambda x: dates.in_open_window(x, a, b)) == [False, False, True, False, False]
    assert column(spark, times, kind, lambda x: dates.on_day(x, b)) == [False, False, False, True, False]


def test_base_currency(spark):
    rows = spark.createDataFrame(
        [(D("100.00"), "USD"), (D("100.00"), "GBP"), (D("100.00"), None)], "a decimal(18,2), c string"
    )
    got = rows.select(money.in_base_currency(F.col("a"), F.col("c"), F.lit(D("160")))).collect()
    assert [r[0] for r in got] == [D("16000.00"), D("100.00"), D("100.00")]


def test_tax_exclusive_and_flag(spark):
    rows = spark.createDataFrame(
        [(D("116.00"), D("0.00")), (D("116.00"), None), (D("116.00"), D("16.00"))],
        "a decimal(18,2), t decimal(18,2)",
    )
    got = rows.select(money.tax_exclusive(F.col("a"), F.col("t"))).collect()
    assert [r[0] for r in got] == [D("116.00"), D("116.00"), D("100.00")]
    assert column(spark, [0.0, None, 5.0], "double", lambda x: money.distribution_flag(x)) == ["N", "Y", "Y"]


def test_smaller_or_second_is_not_least(spark):
    rows = spark.createDataFrame([(1, 2), (3, 2), (None, 2)], "a int, b int")
    got = rows.select(money.smaller_or_second(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [1, 2, 2]


@pytest.mark.parametrize(
    ("value", "expected"), [("40", "0.4"), ("9", "0.09"), ("0.0329", "0.000329"), ("100", "1"), ("0", "0")]
)
def test_fraction(value, expected):
    assert money.fraction(D(value)) == D(expected)


def test_codes(spark):
    assert column(spark, ["R", "I", "Z", None], "string", lambda x: codes.decode(x, codes.ACCOUNT_TYPES)) == [
        "External", "Internal", "Z", None,
    ]
    rows = spark.createDataFrame(
        [(None, "Y"), ("Y", None), ("Y", "Y"), ("N", "N")], "r string, i string"
    )
    got = rows.select(codes.matching_level(F.col("r"), F.col("i"))).collect()
    assert [r[0] for r in got] == ["2-Way", "3-Way", "4-Way", "2-Way"]


def test_join_text_keeps_separators_of_null_parts(spark):
    rows = spark.createDataFrame([("A", None, "B")], "a string, b string, c string")
    got = rows.select(codes.join_text(" ", F.col("a"), F.col("b"), F.col("c"))).head()[0]
    assert got == "A  B"


def test_byte_prefix_does_not_cut_a_character(spark):
    got = column(spark, ["Ship To Site", "1234567é", "ab", None], "string", lambda x: codes.byte_prefix(x, 8))
    assert got == ["Ship To ", "1234567", "ab", None]
