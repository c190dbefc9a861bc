"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.catalog.QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    assert name in registry.oracle_sql()
    assert compare(spark, duck, name, SF) == []


def test_entry(spark):
    frame = registry.entry(spark)
    assert frame.columns[:2] == ["invoiceNumber", "invoiceDate"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", ["ar_offers", "ar_offers_capped"])
def test_offer_properties(spark, name):
    offers = registry.queries()[name](spark, "/root/testdata/sf0.01").collect()
    assert len({o.invoiceNumber for o in offers}) == len(offers) == 2388
    assert all(0 <= o.discountedAmount <= o.maxAllowedOffer for o in offers)
    assert all(o.offeredPaymentDate <= o.originalPaymentDate for o in offers)
    capped = sum(0 < o.discountedAmount == o.maxAllowedOffer for o in offers)
    assert capped == (0 if name == "ar_offers" else 380)


def test_enrichment_keeps_the_number_of_payables(spark):
    """Repeated supplier rows come down to one, so no invoice is offered twice."""
    from netdays.plans.payables import eligible_suppliers
    from netdays.sources import payables, standins

    master = payables.supplier_master(
        payables.supplier_extract(standins.supplier_relations(spark, SF))
    )
    parties = eligible_suppliers(master.withColumnRenamed("supplierName", "name").withColumn("supplierId", master.vendorId))
    invoices = standins.payable_invoices(spark, SF)
    joined = invoices.join(parties, "vendorId", "left")
    assert joined.count() == invoices.count()
