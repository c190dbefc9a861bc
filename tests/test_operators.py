from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from netdays.operators import consolidate, ids, incremental, joins, lookups, quality, tiers, updates
from netdays.operators.pricing import price_payables, price_receivables, price_whole_term
from netdays.params import (
    CAPPED_CUSTOMER,
    SAMPLE_CUSTOMER,
    SAMPLE_SUPPLIER,
    CustomerParams,
    SupplierParams,
)
from netdays.plans import reports

DAY = dt.date(2024, 1, 30)
LINES = (
    "invoiceNumber string, lineId bigint, invoiceGrossValue decimal(18,2), invoiceDate date,"
    " customerNumber bigint, invoiceCurrencyCode string, customerKey string"
)


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_lines_become_one_invoice(spark):
    lines = spark.createDataFrame(
        [
            ("1", 2, D("5.50"), DAY, 7, "USD", "a_7"),
            ("1", 1, D("10.00"), DAY, 7, None, "a_7"),
            ("2", 1, None, DAY, 8, "KES", None),
            (None, 1, D("3.00"), DAY, 8, "KES", None),
        ],
        LINES,
    )
    got = consolidate.consolidate_lines(lines, ["lineId"])
    assert rows_of(got, "invoiceNumber", "invoiceGrossValue", "invoiceCurrencyCode") == [
        ("1", D("15.50"), "USD"),
        ("2", D("0.00"), "KES"),
    ]


def test_headers_and_flat_lines_agree(spark):
    random.seed(5)
    headers = [(str(i), DAY, i % 5, random.choice(["USD", "KES"]), f"k_{i % 5}") for i in range(50)]
    lines = [(str(random.randrange(60)), n, D(random.randrange(10**6)) / 100) for n in range(500)]
    h = spark.createDataFrame(
        headers,
        "invoiceNumber string, invoiceDate date, customerNumber bigint,"
        " invoiceCurrencyCode string, customerKey string",
    )
    ln = spark.createDataFrame(
        lines, "invoiceNumber string, lineId bigint, invoiceGrossValue decimal(18,2)"
    )
    by_header = consolidate.consolidate_to_headers(h, ln)
    flat = consolidate.consolidate_lines(h.join(ln, "invoiceNumber"), ["lineId"])
    columns = sorted(flat.columns)
    assert rows_of(by_header, *columns) == rows_of(flat, *columns)


def test_first_takes_the_first_value_that_is_not_null(spark):
    sites = spark.createDataFrame(
        [("k", 2, "b", None), ("k", 1, None, "x"), ("k", 3, "c", "y"), (None, 1, "d", "z")],
        "customerKey string, n int, name string, email string",
    )
    got = consolidate.one_row_per_party(sites, "customerKey", ["name", "email"], ["n"])
    assert rows_of(got, "customerKey", "name", "email") == [("k", "b", "x")]


def test_watermark(spark):
    offers = spark.createDataFrame([(DAY,), (dt.date(2023, 5, 1),)], "invoiceDate date")
    assert incremental.watermark(offers, dt.date(2025, 4, 30)) == DAY
    assert incremental.watermark(offers.limit(0), dt.date(2025, 4, 30)) == dt.date(2025, 2, 28)


def test_watermark_day_brings_only_what_is_new(spark):
    invoices = spark.createDataFrame([(1, DAY), (2, DAY), (None, DAY)], "invoiceNumber bigint, d date")
    offered = spark.createDataFrame([("1",), ("1",), (None,), ("no number",)], "invoiceNumber string")
    got = incremental.not_yet_offered(invoices, offered, "invoiceNumber")
    assert {r[0] for r in got.collect()} == {2, None}


def test_missing_parties_and_key_list_with_null(spark):
    incoming = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "customerKey string")
    known = spark.createDataFrame([("b",), (None,)], "customerKey string")
    missing = incremental.missing_parties(incoming, known, "customerKey")
    assert [r[0] for r in missing.collect()] == ["a"]
    parties = spark.createDataFrame([("a", 1), ("c", 2), (None, 3)], "customerKey string, n int")
    assert rows_of(incremental.only_keys(parties, incoming, "customerKey"), "n") == [(1,)]


def half_up(value: D, places: str = "0.0001") -> D:
    return value.quantize(D(places), rounding=ROUND_HALF_UP)


INVOICES = (
    "invoiceNumber int, invoiceDate date, termDays int, invoiceGrossValue decimal(20,2),"
    " invoiceCurrencyCode string"
)


@pytest.mark.parametrize("params", [SAMPLE_CUSTOMER, CAPPED_CUSTOMER])
def test_receivable_prices_against_plain_arithmetic(spark, params):
    random.seed(11)
    rows = [
        (
            i,
            DAY,
            random.choice([14, 21, 30, 35, 45, 60, 90]),
            D(random.randrange(-10**6, 10**9)) / 100,
            random.choice(["USD", "KES", "GBP", None]),
        )
        for i in range(400)
    ]
    got = price_receivables(spark.createDataFrame(rows, INVOICES), params).orderBy("invoiceNumber")
    for row, offer in zip(rows, got.collect(), strict=True):
        _, day, days, gross, currency = row
        early = params.tiers.get(days, 0)
        credit = gross * params.exchange_rate if currency == "USD" else gross
        daily = params.cost_of_finance_per_day / 100 * credit
        wanted = early * daily * params.share_of_savings / 100
        cap = credit * params.max_discount / 100
        discount = half_up(wanted if wanted < cap else cap)
        assert offer.creditAmount == half_up(credit, "0.01")
        assert offer.savedAmount == half_up(early * daily)
        assert offer.maxAllowedOffer == half_up(cap)
        assert offer.totalInterest == half_up(days * daily)
        assert offer.discountedAmount == discount
        assert offer.discountRate == gross - discount
        assert offer.originalPaymentDate == day + dt.timedelta(days=days)
        assert offer.offeredPaymentDate == day + dt.timedelta(days=days - early)
        if gross:
            assert offer.discountPercentage == pytest.approx(float(discount / gross * 100), abs=1e-4)
        if gross >= 0:
            assert discount <= half_up(cap)
        assert offer.offeredPaymentDate <= offer.originalPaymentDate


def test_receivable_price_corner_cases(spark):
    rows = [
        (1, DAY, 35, D("100.00"), "KES"),
        (2, DAY, 60, D("0.00"), "KES"),
        (3, DAY, 60, D("-100.00"), "KES"),
        (4, DAY, 60, D("100.00"), "USD"),
        (5, DAY, 30, D("100.00"), "KES"),
    ]
    got = price_receivables(spark.createDataFrame(rows, INVOICES), SAMPLE_CUSTOMER)
    by = {r.invoiceNumber: r for r in got.collect()}
    assert by[1].discountedAmount == 0
    assert by[1].offeredPaymentDate == by[1].originalPaymentDate
    assert by[2].discountPercentage is None
    assert by[3].discountedAmount == D("-9.0000")
    assert by[4].discountRate == D("100.00") - D("384.0000")
    assert by[4].netPayableBase == D("16000.00") - D("384.0000")
    assert by[4].discountPctOfCredit == 2.4
    assert by[5].originalPaymentDate == dt.date(2024, 2, 29)


def test_minimum_amount(spark):
    rows = spark.createDataFrame([(i, DAY, 30, D(i * 100), "KES") for i in range(1, 5)], INVOICES)
    params = CustomerParams(
        exchange_rate=160, cost_of_finance_per_day="0.2", max_discount=9, share_of_savings=40,
        tiers={30: 15}, minimum_amount=300,
    )
    assert rows_of(price_receivables(rows, params), "invoiceNumber") == [(3,), (4,)]


def test_payable_prices(spark):
    rows = spark.createDataFrame(
        [(1, DAY, 30, D("200.00"), "KES"), (2, DAY, 33, D("200.00"), "KES")], INVOICES
    )
    got = {r.invoiceNumber: r for r in price_payables(rows, SAMPLE_SUPPLIER).collect()}
    assert got[1].discountAmount == D("3.0000")
    assert got[1].discountRate == D("197.0000")
    assert got[1].discountPercentage == D("1.5000")
    assert got[1].offeredPaymentDate == DAY + dt.timedelta(days=15)
    assert got[2].discountAmount == 0
    assert got[2].offeredPaymentDate == got[2].originalPaymentDate


def test_whole_term_forms_differ_on_the_cap_itself(spark):
    params = CustomerParams(
        exchange_rate=1, cost_of_finance_per_day="0.75", max_discount=9, share_of_savings=40,
        tiers={14: 7},
    )
    rows = spark.createDataFrame(
        [(1, DAY, 30, D("100.00"), "KES"), (2, DAY, 14, D("100.00"), "KES"), (3, DAY, 31, D("1.00"), "KES")],
        INVOICES,
    )
    at_cap = price_whole_term(rows, params, ">=")
    assert rows_of(at_cap, "invoiceNumber") == [(1,), (2,)]
    assert rows_of(price_whole_term(rows, params, ">"), "invoiceNumber") == [(2,)]
    strict = price_whole_term(rows, params, ">=", strict_tiers=True)
    assert rows_of(strict, "invoiceNumber", "offerAvailableDate") == [(2, DAY + dt.timedelta(days=7))]


def test_parameters_are_checked():
    request = {
        "exchange_rate": 160.0, "cost_of_finance_per_day": 0.2, "max_discount_amount": 9.0,
        "persentage_of_discount_savings": 40.0, "d_14": 7, "d_21": 11, "d_30": 15, "d_45": 21, "d_60": 30,
    }
    assert CustomerParams.from_request(request) == SAMPLE_CUSTOMER
    assert SupplierParams.from_request({"d_14": (7, 0.7)}).tiers[14].percent == D("0.7")
    assert CustomerParams.from_request(request | {"exchange_rate": "129.12345", "max_discount_amount": 101}).exchange_rate == D("129.12345")
    with pytest.raises(ValueError):
        CustomerParams.from_request(request | {"max_discount_amount": -1})
    with pytest.raises(ValueError):
        CustomerParams.from_request(request | {"exchange_rate": 0})
    with pytest.raises(ValueError):
        CustomerParams.from_request(request | {"exchange_rate": "0.123456789012345678"})


def test_many_tiers(spark):
    params = SupplierParams({n: (n % 9, n % 5) for n in range(0, 12_000, 2)})
    rows = spark.createDataFrame([(8,), (9,), (11_998,), (None,)], "n int")
    got = rows.select(tiers.early_days(F.col("n"), params), tiers.tier_percent(F.col("n"), params)).collect()
    assert [tuple(r) for r in got] == [(8, D("3.0000")), (0, D("0.0000")), (1, D("3.0000")), (0, D("0.0000"))]


def test_tier_join_agrees_with_the_expression(spark):
    rows = spark.range(0, 400).select(F.col("id").cast("int").alias("termDays"))
    joined = tiers.join_tiers(rows, tiers.tier_table(spark, SAMPLE_SUPPLIER), "termDays")
    direct = rows.select(
        "termDays",
        tiers.early_days(F.col("termDays"), SAMPLE_SUPPLIER).alias("earlyDays"),
        tiers.tier_percent(F.col("termDays"), SAMPLE_SUPPLIER).alias("percent"),
    )
    columns = ("termDays", "earlyDays", "percent")
    assert rows_of(joined, *columns) == rows_of(direct, *columns)
    none = tiers.join_tiers(rows, tiers.tier_table(spark, SupplierParams()), "termDays", strict=True)
    assert none.isEmpty()


def test_first_match_keeps_columns_of_one_row(spark):
    rows = spark.createDataFrame([(1, 9, None, "q"), (1, 3, "b", None), (2, 5, "c", "r")], "k int, o int, a string, b string")
    got = lookups.first_match(rows, ["k"], ["o"], ["a", "b"])
    assert {tuple(r) for r in got.collect()} == {(1, "b", None), (2, "c", "r")}


def test_membership_flag(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, n string")
    members = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    got = lookups.membership_flag(rows, members, "k", "f", ["n"])
    assert rows_of(got, "n", "f") == [("a", "Yes"), ("b", "No"), ("c", "No")]


def test_spread_join_equals_a_plain_join(spark):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    table = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    spread = joins.spread_left_join(rows, table, ["k"], ["id"])
    plain = rows.join(table, "k", "left")
    assert spread.exceptAll(plain.select(*spread.columns)).isEmpty()
    assert spread.count() == 2000


def test_pivots(spark):
    pairs = spark.createDataFrame(
        [(1, "Size", "2L"), (1, "Size", "1L"), (1, "Other", "x"), (2, "Product Code", "P2")],
        "itemId int, elementName string, elementValue string",
    )
    got = {r.itemId: r for r in lookups.item_attributes(pairs).collect()}
    assert (got[1].skuSize, got[1].productCode) == ("1L", None)
    assert got[2].productCode == "P2"
    limits = spark.createDataFrame([(1, "KES", 5), (1, "USD", 2), (1, "EUR", 9)], "k int, currencyCode string, creditLimit int")
    assert rows_of(lookups.credit_limits(limits, ["k"]), "kesCreditLimit", "usdCreditLimit", "gbpCreditLimit") == [(5, 2, None)]


def test_unit_cost_rounds_and_skips_zero(spark):
    costs = spark.createDataFrame(
        [(1, 1, D("1.2345678"), 2), (2, 1, D("0"), 2), (3, 1, D("4"), 1)],
        "itemId int, organizationId int, itemCost decimal(12,7), costTypeId int",
    )
    assert rows_of(lookups.nonzero_unit_cost(costs), "itemId", "unitCost") == [(1, D("1.23457"))]


def test_dense_ids(spark):
    rows = spark.range(0, 1000, numPartitions=7).select((999 - F.col("id")).alias("k"))
    got = rows_of(ids.dense_ids(rows, "n", first=5, order=["k"]), "n", "k")
    assert got == [(i + 5, i) for i in range(1000)]
    unordered = ids.dense_ids(rows.filter("k % 2 = 0"), "n")
    assert sorted(r.n for r in unordered.collect()) == list(range(1, 501))


def test_updates(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k bigint, s string")
    change = spark.createDataFrame([("2", "z"), ("2", "c"), ("9", "q"), (None, "n"), ("x", "q")], "k string, s string")
    assert rows_of(updates.update_column(table, change, "k", "s").fillna("-"), "k", "s") == [
        (1, "a"), (2, "z"), (3, "-"),
    ]
    timed = spark.createDataFrame([("2", "z", 1), ("2", "c", 2), ("1", None, 3)], "k string, s string, t int")
    assert rows_of(updates.update_column(table, timed, "k", "s", "t").fillna("-"), "k", "s") == [
        (1, "a"), (2, "c"), (3, "-"),
    ]
    assert {r.k for r in updates.updates_without_row(table, change, "k").collect()} == {"9", "x", None}


def test_quality(spark):
    rows = spark.createDataFrame([(1, "abc", None), (2, None, "x"), (None, "abcdef", "y")], "k int, a string, b string")
    assert tuple(quality.null_counts(rows).head()) == (1, 1, 1)
    assert rows_of(quality.too_long(rows.filter("k is null or k < 9"), {"a": 3, "b": 5}, "a"), "field", "length") == [("a", 6)]
    marked = quality.with_reject_reason(rows, quality.not_null_rules(["k", "a"]))
    assert {r.rejectReason for r in quality.rejected(marked).collect()} == {"a missing", "k missing"}
    assert quality.accepted(marked).count() == 1
    parents = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows_of(quality.orphans(rows, parents, "k", "id"), "k") == [(2,)]
    assert consolidate.repeated_keys(spark.createDataFrame([("p",), ("p",), ("q",)], "k string"), "k").collect()[0].n == 2


def test_stable_id_depends_on_the_key_alone(spark):
    rows = spark.range(0, 500, numPartitions=5).withColumn("k", F.concat(F.lit("k"), "id"))
    first = rows_of(rows.select("k", ids.stable_id("k").alias("n")), "k", "n")
    again = rows_of(rows.repartition(3).select("k", ids.stable_id("k").alias("n")), "k", "n")
    assert first == again
    assert len({n for _, n in first}) == 500


def test_preview_and_types(spark):
    rows = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "n int, s string")
    assert [r.n for r in reports.preview(rows, ["n"], 2).collect()] == [1, 2]
    assert reports.column_types(rows) == {"n": "int", "s": "string"}


def test_joined_rows_prefer_the_invoice(spark):
    invoices = spark.createDataFrame([(1, "i", 5)], "customerId int, name string, amount int")
    customers = spark.createDataFrame([(1, "c", "e")], "customerId int, name string, email string")
    got = reports.invoices_with_customer(invoices, customers, "customerId").head()
    assert (got.name, got.email, got.amount) == ("i", "e", 5)


def test_complete_parties_fills_absent_columns(spark):
    known = spark.createDataFrame([("a", "x")], "customerKey string, phone string")
    fetched = spark.createDataFrame([("b",)], "customerKey string")
    got = incremental.complete_parties(known, fetched)
    assert {tuple(r) for r in got.collect()} == {("a", "x"), ("b", None)}


def test_single_row_keeps_counts_and_flags_what_differs(spark):
    table = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 5), (2, "b", 5), (2, "b", 6), (3, None, 1), (3, "c", 1), (4, None, None), (4, None, None), (None, "n", 1)],
        "k int, t string, v int",
    )
    found = {r.k: (r.t, r.v, r.odd) for r in lookups.single_row(table, ["k"], ["t", "v"], "reject", "odd").collect()}
    assert found == {1: ("a", 5, False), 2: (None, None, True), 3: (None, None, True), 4: (None, None, False), None: ("n", 1, False)}
    single = lookups.single_row(table, ["k"], ["t", "v"])
    assert single.where("k = 1").head().t == "a"
    with pytest.raises(Exception, match="several values of t, v for k = 2"):
        single.where("k = 2").collect()
    with pytest.raises(ValueError, match="raise or reject"):
        lookups.single_row(table, ["k"], ["v"], "ignore")
    assert lookups.single_row(table.limit(0), ["k"], ["v"]).collect() == []


def test_single_limits(spark):
    rows = spark.createDataFrame(
        [(1, "KES", 5), (1, "KES", 5), (1, "USD", 2), (1, "USD", 3), (2, "GBP", None), (2, "EUR", 1), (3, "EUR", 1)],
        "k int, currencyCode string, creditLimit int",
    )
    found = lookups.single_credit_limits(rows, ["k"], "reject", "odd")
    got = {r.k: (r.kesCreditLimit, r.usdCreditLimit, r.gbpCreditLimit, r.odd) for r in found.collect()}
    assert got == {1: (5, None, None, "usdCreditLimit"), 2: (None, None, None, None)}
    with pytest.raises(Exception, match="several values of usdCreditLimit for k = 1"):
        lookups.single_credit_limits(rows, ["k"]).collect()
