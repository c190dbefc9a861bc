from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from test_extracts import customer_erp, payable_erp

from netdays import schemas
from netdays.operators.updates import update_column
from netdays.params import SAMPLE_CUSTOMER, SAMPLE_SUPPLIER
from netdays.plans import reports
from netdays.plans.runs import append_checked, run_payables, run_receivables
from netdays.sources import files
from netdays.sources.ledger import Ledger

AS_OF = dt.date(2024, 3, 31)
DAY = dt.datetime(2024, 3, 10, 9)


def line(number, trx=1, gross="100.00", site="West-01", day=DAY, n=0):
    return dict(
        customer_trx_id=trx, customer_trx_line_id=hash((number, n)) % 1000, invoice_number=number,
        invoice_date=day, invoice_gross_value=D(gross), invoice_currency_code="KES",
        ship_to_locations1=site,
    )


def receivable_erp(spark, lines, **extra):
    return customer_erp(
        spark,
        invoice_lines=lines,
        ra_customer_trx_all=[dict(customer_trx_id=1, sold_to_customer_id=70)],
        **extra,
    )


def test_receivable_runs(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    first = [line("1", gross="60.00"), line("1", gross="40.00", n=1), line("2"), line("3", day=dt.datetime(2024, 1, 1))]
    result = run_receivables(ledger, receivable_erp(spark, first), SAMPLE_CUSTOMER, AS_OF)
    assert (result.watermark, result.inserted, result.new_parties) == (dt.date(2024, 1, 31), 2, 1)
    assert result.invoices == 2
    offers = {r.invoiceNumber: r for r in ledger.read("customerOffers").collect()}
    assert set(offers) == {"1", "2"}
    assert offers["1"].creditAmount == D("100.00")
    assert offers["1"].offerStatus == "not_sent"
    assert offers["1"].offeredPaymentDate == dt.date(2024, 3, 25)
    assert sorted(r.customerOfferId for r in offers.values()) == [1, 2]
    customer = ledger.read("customers").head()
    assert {r.customerId for r in offers.values()} == {customer.customerId}

    again = run_receivables(ledger, receivable_erp(spark, first), SAMPLE_CUSTOMER, AS_OF)
    assert (again.watermark, again.inserted, again.message) == (DAY.date(), 0, "already inserted")

    # A new invoice on the watermark day, and a new site of the known customer.
    more = [*first, line("4"), line("5", site="East")]
    third = run_receivables(ledger, receivable_erp(spark, more), SAMPLE_CUSTOMER, AS_OF)
    assert (third.inserted, third.new_parties, third.message) == (2, 1, "inserted")
    rows = ledger.read("customerOffers")
    assert sorted(r.customerOfferId for r in rows.collect()) == [1, 2, 3, 4]
    assert rows.select("invoiceNumber").distinct().count() == 4
    assert {r.customerKey for r in ledger.read("customers").collect()} == {"west01_7", "east_7"}


def test_unreadable_terms_do_not_stop_a_run(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    erp = receivable_erp(
        spark,
        [line("1"), line("2", site="East"), line("3", gross="0.00")],
        ra_terms_tl=[
            dict(term_id=1, language="US", name="30 Days Net"),
            dict(term_id=2, language="US", name="Net 45 Days Net"),
        ],
    )
    result = run_receivables(ledger, erp, SAMPLE_CUSTOMER, AS_OF)
    # Invoice 2 has unreadable terms, invoice 3 no percentage.
    assert (result.inserted, result.rejected) == (1, 2)
    for _ in range(2):
        kept = sorted((r.rejectReason, r.rejectKey) for r in ledger.rejects("customerOffers").collect())
        assert kept == [("creditTerms not readable", "2"), ("discountPercentage missing", "3")]
        run_receivables(ledger, erp, SAMPLE_CUSTOMER, AS_OF)


def test_payable_runs(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    erp = payable_erp(spark)
    result = run_payables(ledger, erp, SAMPLE_SUPPLIER, AS_OF, org_id=82)
    # Five distinct invoices of the vendor (one of another unit, one unknown vendor).
    assert (result.watermark, result.inserted, result.new_parties) == (dt.date(2024, 1, 31), 5, 1)
    assert result.invoices == 5
    payments = {r.invoiceNumber: r for r in ledger.read("supplierPayment").collect()}
    assert payments["A"].creditAmount == D("116.00")
    assert payments["A"].discountRate == D("114.2600")
    assert payments["A"].invoiceUniqueKey == "5_A"
    assert payments["F"].glDate == dt.date(2024, 3, 1)
    again = run_payables(ledger, erp, SAMPLE_SUPPLIER, AS_OF, org_id=82)
    assert (again.watermark, again.inserted) == (dt.date(2024, 3, 1), 0)


def test_empty_ledger_and_checked_append(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    ledger.create()
    ledger.create()
    assert ledger.read("suppliers").isEmpty()
    assert ledger.watermark("customerOffers", dt.date(2025, 4, 30)) == dt.date(2025, 2, 28)
    rows = spark.createDataFrame(
        [(1, "n", "30 Days Net"), (None, "m", None)], "vendorId bigint, name string, creditTerms string"
    )
    assert append_checked(ledger, "suppliers", rows, "supplierId") == (1, 1)
    assert append_checked(ledger, "suppliers", rows.filter("vendorId = 1"), "supplierId") == (1, 0)
    assert sorted(r.supplierId for r in ledger.read("suppliers").collect()) == [1, 2]


def test_status_update_makes_a_new_snapshot(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    run_receivables(ledger, receivable_erp(spark, [line("1"), line("2")]), SAMPLE_CUSTOMER, AS_OF)
    decided = spark.createDataFrame([("2", "accepted")], "invoiceNumber string, offerStatus string")
    updated = update_column(ledger.read("customerOffers"), decided, "invoiceNumber", "offerStatus")
    switched = ledger.write_snapshot("customerOffers", updated, str(tmp_path / "v2"))
    statuses = {r.invoiceNumber: r.offerStatus for r in switched.read("customerOffers").collect()}
    assert statuses == {"1": "not_sent", "2": "accepted"}
    assert {r.offerStatus for r in ledger.read("customerOffers").collect()} == {"not_sent"}
    assert switched.watermark("customerOffers", AS_OF) == DAY.date()

    report = reports.customer_offer_report(switched.read("customerOffers"), switched.read("customers"))
    assert report.count() == 2
    assert {r.name for r in report.collect()} == {"Seven"}
    reports.export_by_status(report, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        ledger.write_snapshot("customerOffers", updated, str(tmp_path / "v2"))


def test_file_sources(spark, tmp_path):
    path = str(tmp_path / "ar")
    spark.createDataFrame(
        [("I1", "2024-01-30", 7, D("5.00"), "USD", " West "), ("I1", "2024-01-30", 7, D("6.00"), "USD", " West ")],
        "INVOICE_NUMBER string, INVOICE_DATE string, `Customer No` int, INVOICE_GROSS_VALUE decimal(18,2),"
        " INVOICE_CURRENCY_CODE string, SHIP_TO_LOCATIONS1 string",
    ).write.option("header", True).csv(path)
    lines = files.receivable_lines(spark.read.option("header", True).csv(path))
    assert {r.customerKey for r in lines.collect()} == {"west_7"}
    assert lines.agg(F.sum("invoiceGrossValue")).head()[0] == D("11.00")

    copies = spark.createDataFrame(
        [(5, "A", "2024-01-30", D("5.00"))] * 2,
        "VENDOR_ID int, ` Invoice Number` string, `Invoice Date` string, `Inclusive KSH` decimal(18,2)",
    )
    assert [r.invoiceUniqueKey for r in files.payable_invoices(copies).collect()] == ["5_A"]
    master = spark.createDataFrame(
        [("7", "Seven", "e", "p", "T", "30 Days Net", "Ea st")],
        "`Customer No` string, `Customer Name` string, EMAIL_ADDRESS string, `Phone Number` string,"
        " `Customer Type` string, Terms string, Location string",
    )
    assert files.customer_sites(master).head().customerKey == "east_7"
    suppliers = spark.createDataFrame(
        [("5", "Five", "VENDOR", "30 Days Net", "1", "e")] * 2,
        "`SUPPLIER ID` string, `SUPPLIER NAME` string, `SUPPLIER TYPE` string, `PAY TERMS` string,"
        " PHONE string, EMAIL_ADDRESS string",
    )
    assert files.supplier_rows(suppliers).count() == 1


def test_csv_with_schema(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.createDataFrame(
        [(1, "2024-05-01", D("200000.00"), "KES", "A, B", "30 Days Net", None), (2, "no date", D("1.00"), "USD", None, None, "e")],
        schemas.CUSTOMER_INVOICE_CSV,
    )
    files.write_csv(rows, path, partition_by=["invoice_currency"])
    got = files.read_csv(spark, path, schemas.CUSTOMER_INVOICE_CSV, ["invoice_date"]).orderBy("invoice_id").collect()
    assert [r.invoice_date for r in got] == [dt.date(2024, 5, 1), None]
    assert (got[0].customer_name, got[0].invoice_gross_value) == ("A, B", D("200000.00"))


def test_run_without_any_invoice(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    result = run_receivables(ledger, receivable_erp(spark, []), SAMPLE_CUSTOMER, AS_OF)
    assert (result.invoices, result.inserted, result.message) == (0, 0, "already inserted")
    payables = run_payables(ledger, payable_erp(spark, ap_invoices_v=[]), SAMPLE_SUPPLIER, AS_OF)
    assert (payables.invoices, payables.inserted, payables.new_parties) == (0, 0, 0)


def test_number_that_is_none_is_a_reject_and_its_invoices_wait(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    erp = receivable_erp(spark, [line("1")], ar_customers=[
        dict(customer_id=70, customer_number="N7", customer_name="Seven", customer_class_code="A", status="A")
    ])
    result = run_receivables(ledger, erp, SAMPLE_CUSTOMER, AS_OF)
    assert (result.inserted, result.new_parties, result.waiting) == (0, 0, 1)
    reject = ledger.rejects("customers").head()
    assert reject.rejectReason == "customerNumber not a number" and '"statedNumber":"N7"' in reject.row
    # The number is put right: what waited is offered, by the run that loads its customer.
    mended = receivable_erp(spark, [line("1"), line("2", day=dt.datetime(2024, 3, 11))])
    again = run_receivables(ledger, mended, SAMPLE_CUSTOMER, AS_OF, dt.datetime(2024, 3, 31, 5))
    assert (again.inserted, again.waiting) == (2, 0)
    assert {r.createAt for r in ledger.read("customerOffers").collect()} == {dt.datetime(2024, 3, 31, 5)}


def test_lines_of_offered_invoices_leave_before_the_sum(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    run_receivables(ledger, receivable_erp(spark, [line("1"), line("2")]), SAMPLE_CUSTOMER, AS_OF)
    again = run_receivables(ledger, receivable_erp(spark, [line("1"), line("2", n=5), line("3")]), SAMPLE_CUSTOMER, AS_OF)
    assert (again.invoices, again.inserted, again.waiting) == (3, 1, 0)
    assert ledger.read("customerOffers").count() == 3
