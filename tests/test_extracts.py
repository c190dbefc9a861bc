from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

from erp import relations

from netdays.sources import payables, receivables
from netdays.sources.relations import JdbcConnection, JdbcSplit, staged_relations

DAY = dt.datetime(2024, 1, 30, 8)


def test_invoice_lines_and_item_details(spark):
    erp = relations(
        spark,
        invoice_lines=[
            dict(customer_trx_id=1, customer_trx_line_id=11, invoice_number="I1", invoice_date=DAY,
                 invoice_gross_value=D("10.00"), invoice_currency_code="USD",
                 ship_to_locations1=" West-01 ", inventory_item_id=5, organization_id=1),
            dict(customer_trx_id=9, customer_trx_line_id=12, invoice_number="I2", invoice_date=DAY,
                 invoice_gross_value=D("1.00"), ship_to_locations1=None, inventory_item_id=6, organization_id=1),
            dict(customer_trx_id=1, customer_trx_line_id=13, invoice_number="I3",
                 invoice_date=dt.datetime(2024, 1, 29, 23)),
        ],
        ra_customer_trx_all=[dict(customer_trx_id=1, sold_to_customer_id=70)],
        ar_customers=[dict(customer_id=70, customer_number="7.0")],
        cst_item_cost_type_v=[
            dict(inventory_item_id=5, organization_id=1, item_cost=D("2.0000049"), cost_type_id=2),
            dict(inventory_item_id=5, organization_id=1, item_cost=D("9"), cost_type_id=1),
            dict(inventory_item_id=6, organization_id=1, item_cost=D("0"), cost_type_id=2),
        ],
        mtl_descr_element_values_v=[
            dict(inventory_item_id=5, element_name="Size", element_value="2L"),
            dict(inventory_item_id=5, element_name="Size", element_value="1L"),
            dict(inventory_item_id=5, element_name="Colour", element_value="red"),
        ],
    )
    lines = receivables.invoice_lines(erp, dt.date(2024, 1, 30))
    got = {r.invoiceNumber: r for r in receivables.with_item_details(lines, erp).collect()}
    assert set(got) == {"I1", "I2"}
    assert (got["I1"].customerKey, got["I1"].customerNumber) == ("west01_7", "7")
    assert (got["I2"].customerKey, got["I2"].customerNumber) == ("_None", None)
    assert (got["I1"].unitCost, got["I1"].skuSize, got["I1"].productCode) == (D("2.00000"), "1L", None)
    assert got["I2"].unitCost is None


def customer_erp(spark, **extra):
    """Customer 7 with two active site uses, an inactive one, bank and contacts."""
    base = dict(
        ar_customers=[
            dict(customer_id=70, customer_number="7", customer_name="Seven", status="A"),
            dict(customer_id=80, customer_number="8", customer_name="Eight", status="I"),
        ],
        hz_cust_accounts=[
            dict(cust_account_id=70, party_id=700, customer_type="R"),
            dict(cust_account_id=80, party_id=800),
        ],
        hz_cust_acct_sites_all=[
            dict(cust_acct_site_id=1, cust_account_id=70, party_site_id=11),
            dict(cust_acct_site_id=2, cust_account_id=70, party_site_id=12),
            dict(cust_acct_site_id=3, cust_account_id=80, party_site_id=11),
        ],
        hz_cust_site_uses_all=[
            dict(site_use_id=101, cust_acct_site_id=1, site_use_code="BILL_TO", location="West-01",
                 status="A", payment_term_id=1),
            dict(site_use_id=102, cust_acct_site_id=2, location="East", status="A", payment_term_id=2),
            dict(site_use_id=103, cust_acct_site_id=2, location="Gone", status="I"),
            dict(site_use_id=104, cust_acct_site_id=3, location="Other", status="A"),
        ],
        hz_party_sites=[dict(party_site_id=11, party_id=700, location_id=5), dict(party_site_id=12, party_id=700, location_id=5)],
        hz_locations=[dict(location_id=5, city="Town")],
        hz_parties=[
            dict(party_id=700, party_type="ORGANIZATION", creation_date=dt.date(2020, 2, 1), email_address="m@example.com"),
            dict(party_id=701, party_type="PERSON"),
            dict(party_id=900, party_type="ORGANIZATION", party_name="Bank"),
            dict(party_id=901, party_type="ORGANIZATION", party_name="Branch"),
        ],
        hz_customer_profiles=[
            dict(cust_account_id=70, credit_checking="Y"), dict(cust_account_id=70, credit_checking="Y"),
            dict(cust_account_id=80, credit_checking="N"),
        ],
        ra_terms_tl=[
            dict(term_id=1, language="US", name="30 Days Net"), dict(term_id=1, language="FR", name="30 jours"),
            dict(term_id=2, language="US", name="45 Days Net"),
        ],
        ar_lookups=[
            dict(lookup_type="SITE_USE_CODE", lookup_code="BILL_TO", meaning="Bill To Site"),
            dict(lookup_type="OTHER", lookup_code="BILL_TO", meaning="x"),
        ],
        hz_cust_profile_amts=[
            dict(cust_account_id=70, site_use_id=101, currency_code="KES", overall_credit_limit=D("500.00")),
            dict(cust_account_id=70, site_use_id=None, currency_code="USD", overall_credit_limit=D("1.00")),
        ],
        hz_relationships=[
            dict(relationship_id=1, object_id=700, subject_id=701, party_id=702),
            dict(relationship_id=2, relationship_code="BRANCH_OF", object_id=900, object_type="ORGANIZATION",
                 object_table_name="HZ_PARTIES", subject_id=901, subject_type="ORGANIZATION",
                 subject_table_name="HZ_PARTIES"),
        ],
        hz_org_contacts=[dict(party_relationship_id=1, org_contact_id=33)],
        hz_cust_account_roles=[dict(cust_account_id=70, cust_acct_site_id=1, party_id=703)],
        hz_contact_points=[
            dict(contact_point_id=21, owner_table_id=703, contact_point_type="PHONE", phone_country_code="254",
                 phone_number="123", status="A"),
            dict(contact_point_id=20, owner_table_id=703, contact_point_type="PHONE", phone_number="9", status="A"),
            dict(contact_point_id=22, owner_table_id=703, contact_point_type="EMAIL", email_address="c@example.com"),
            dict(contact_point_id=23, owner_table_id=702, contact_point_type="WEB", status="A"),
        ],
        ar_contacts_v=[
            dict(contact_point_id=21, org_contact_id=33, first_name="F", job_title="Buyer"),
            dict(contact_point_id=20, org_contact_id=99, first_name="Wrong", job_title="None"),
        ],
        hz_organization_profiles=[dict(party_id=900), dict(party_id=901)],
        iby_ext_bank_accounts=[
            dict(ext_bank_account_id=2, bank_id=900, branch_id=901, bank_account_num="B2"),
            dict(ext_bank_account_id=1, bank_id=900, branch_id=901, bank_account_num="B1"),
        ],
        iby_pmt_instr_uses_all=[dict(instrument_id=1, ext_pmt_party_id=4), dict(instrument_id=2, ext_pmt_party_id=4)],
        iby_external_payers_all=[dict(ext_payer_id=4, cust_account_id=70, acct_site_use_id=101)],
    )
    return relations(spark, **(base | extra))


def test_banks_belong_to_the_account_site(spark):
    """Both uses of a site have the account of one of them; a site of another party has none."""
    uses = [
        dict(site_use_id=101, cust_acct_site_id=1, location="West-01", status="A"),
        dict(site_use_id=105, cust_acct_site_id=1, location="West-02", status="A"),
    ]
    got = receivables.customer_extract(customer_erp(spark, hz_cust_site_uses_all=uses)).collect()
    assert {(r.location, r.bankAccountNumber) for r in got} == {("West-01", "B1"), ("West-02", "B1")}
    foreign = [dict(party_site_id=11, party_id=999, location_id=5)]
    got = receivables.customer_extract(customer_erp(spark, hz_cust_site_uses_all=uses, hz_party_sites=foreign)).collect()
    assert {(r.bankAccountNumber, r.phone, r.contactPerson) for r in got} == {(None, None, None)}


def test_customer_extract(spark):
    got = {r.location: r for r in receivables.customer_extract(customer_erp(spark)).collect()}
    assert set(got) == {"West-01", "East"}
    west, east = got["West-01"], got["East"]
    assert (west.customerKey, west.creditTerms, west.siteUse) == ("west01_7", "30 Days Net", "Bill To ")
    assert (west.accountType, west.creditCheck, west.creationDate) == ("External", "Yes", "01-02-2020")
    assert (west.kesCreditLimit, west.usdCreditLimit) == (D("500.00"), None)
    assert (west.bankName, west.bankBranchName, west.bankAccountNumber) == ("Bank", "Branch", "B1")
    assert (west.phone, west.contactEmail) == ("--9", "c@example.com")
    assert (west.contactPerson, west.jobTitle) == ("F ", "Buyer")
    assert (east.bankName, east.phone, east.contactPerson, east.creditTerms) == (None, None, None, "45 Days Net")
    assert len(west) == 62


def test_customer_extract_of_a_key_list_with_null(spark):
    erp = customer_erp(spark)
    wanted = spark.createDataFrame([("8",), (None,)], "customerNumber string")
    assert receivables.customer_extract(erp, wanted).isEmpty()
    wanted = spark.createDataFrame([(7,), (7,), (None,)], "customerNumber bigint")
    assert receivables.customer_master(erp, wanted).count() == 2


def test_fewer_columns_mean_fewer_joins(spark):
    erp = customer_erp(spark)
    wide = receivables.customer_rows(erp)._jdf.queryExecution().optimizedPlan().toString()
    slim = receivables.customer_rows(erp, columns=["customerNumber", "name"])
    assert slim._jdf.queryExecution().optimizedPlan().toString().count("Join") == 7
    assert wide.count("Join") > 20


def payable_erp(spark, **extra):
    invoice = dict(
        vendor_id=5, vendor_number="V5", invoice_date=dt.date(2024, 1, 30), gl_date=dt.date(2024, 2, 1),
        org_id=82, created_by=1, invoice_currency_code="KES", distribution_total=D("5.00"),
        total_tax_amount=D("16.00"), actual_invoice_amount=D("116.00"),
    )
    base = dict(
        ap_invoices_v=[
            invoice | dict(invoice_id=1, invoice_num="A"),
            invoice | dict(invoice_id=2, invoice_num="B", total_tax_amount=None, distribution_total=None),
            invoice | dict(invoice_id=3, invoice_num="C", total_tax_amount=D("0.00"), distribution_total=D("0.00")),
            invoice | dict(invoice_id=4, invoice_num="D", invoice_currency_code="USD", exchange_rate=D("129.5")),
            invoice | dict(invoice_id=5, invoice_num="E", org_id=83),
            invoice | dict(invoice_id=6, invoice_num="F", gl_date=dt.date(2024, 3, 1)),
            invoice | dict(invoice_id=7, invoice_num="G", vendor_number="unknown"),
        ],
        ap_vendors_v=[dict(vendor_number="V5", vendor_type_disp="Vendor")],
        fnd_user=[dict(user_id=1, user_name="clerk")],
        fnd_attached_documents=[
            dict(pk1_value="1", entity_name="AP_INVOICES"), dict(pk1_value="1", entity_name="AP_INVOICES"),
            dict(pk1_value="2", entity_name="OTHER"),
        ],
        ap_suppliers=[
            dict(vendor_id=5, vendor_name="Five", vendor_type_lookup_code="VENDOR", terms_id=1, party_id=50,
                 last_updated_by=1, receipt_required_flag="Y", auto_tax_calc_flag="N"),
            dict(vendor_id=6, vendor_name="Six", vendor_type_lookup_code="EMPLOYEE", last_updated_by=1),
            dict(vendor_id=7, vendor_name="Seven", last_updated_by=1),
            dict(vendor_id=8, vendor_name="Eight", vendor_type_lookup_code="VENDOR", party_id=50, last_updated_by=1),
        ],
        ap_supplier_sites_all=[dict(vendor_id=5, vendor_site_id=51), dict(vendor_id=5, vendor_site_id=52)],
        po_vendor_contacts=[
            dict(vendor_id=5, prefix="A", middle_name="B", phone="1"), dict(vendor_id=5, phone="2"),
        ],
        ap_terms=[dict(term_id=1, name="Net 30 Days Net")],
        iby_external_payees_all=[dict(supplier_site_id=51, bank_charge_bearer="OUR")],
        iby_account_owners=[
            dict(ext_bank_account_id=1, account_owner_party_id=50), dict(ext_bank_account_id=2, account_owner_party_id=50),
        ],
        iby_ext_bank_accounts=[
            dict(ext_bank_account_id=1, bank_id=1, branch_id=2, bank_account_num="N1", bank_account_name="M1"),
            dict(ext_bank_account_id=2, bank_id=3, branch_id=4, bank_account_num="N2", bank_account_name="M2"),
        ],
        iby_ext_banks_v=[dict(bank_party_id=3, bank_name="Third")],
        iby_ext_bank_branches_v=[
            dict(bank_party_id=3, branch_party_id=4, bank_branch_name="Fourth", branch_number="04", eft_swift_code="S"),
        ],
    )
    return relations(spark, **(base | extra))


def test_payable_extract(spark):
    extract = payables.invoice_extract(payable_erp(spark), dt.date(2024, 1, 31), dt.date(2024, 2, 1), org_id=82)
    got = {r.invoiceNumber: r for r in extract.collect()}
    assert set(got) == {"A", "B", "C", "D"}
    assert [got[n].exclusive for n in "ABC"] == [D("100.00"), D("116.00"), D("116.00")]
    assert [got[n].exclusiveBase for n in "ABC"] == [D("100.00"), None, D("116.00")]
    assert [got[n].distributionFlag for n in "ABC"] == ["Y", "Y", "N"]
    assert [got[n].attachments for n in "ABC"] == ["Yes", "No", "No"]
    assert got["D"].inclusiveBase == D("15022.00")
    assert (got["A"].createdBy, got["A"].vendorType) == ("clerk", "Vendor")


def test_supplier_extract(spark):
    erp = payable_erp(spark)
    rows = payables.supplier_extract(erp).collect()
    five = [r for r in rows if r.vendorId == 5]
    assert {r.vendorId for r in rows} == {5, 8}
    assert len(five) == 4
    assert {r.contactName for r in five} == {"A  B ", "   "}
    assert {(r.bankName, r.branchNumber, r.bankAccountNumber) for r in five} == {("Third", "04", "N1")}
    assert {(r.matchingLevel, r.autoCalculateTaxFlag) for r in five} == {("3-Way", "No")}
    eight = next(r for r in rows if r.vendorId == 8)
    assert (eight.vendorSiteId, eight.bankName, eight.bankAccountNumber) == (None, None, None)
    extract = payables.supplier_extract(erp, spark.createDataFrame([(5,), (None,)], "vendorId bigint"))
    assert payables.supplier_rows(extract).count() == 2
    master = payables.supplier_master(extract).collect()
    assert [(r.vendorId, r.phone, r.creditTerms) for r in master] == [(5, "1", "Net 30 Days Net")]


def test_jdbc_options():
    connection = JdbcConnection(
        url="jdbc:x", driver="d", user="u", tables={"invoice_lines": "APPS.LINES_V"},
        splits={"invoice_lines": JdbcSplit("INVOICE_DATE", dt.date(2024, 1, 1), dt.date(2025, 1, 1), 64)},
    )
    options = connection.options("invoice_lines")
    assert options["dbtable"] == "APPS.LINES_V"
    assert (options["partitionColumn"], options["lowerBound"], options["numPartitions"]) == (
        "INVOICE_DATE", "2024-01-01", "64",
    )
    assert "password" not in options
    assert "partitionColumn" not in connection.options("ar_customers")


def test_staged_relations_are_fetched_once(spark):
    erp, fetched = customer_erp(spark), []

    def counting(name):
        fetched.append(name)
        return erp(name)

    staged = staged_relations(counting, receivables.STAGED)
    rows = receivables.customer_extract(staged)
    assert rows.exceptAll(receivables.customer_extract(erp)).isEmpty()
    assert fetched.count("hz_contact_points") == fetched.count("hz_relationships") == 1
    assert fetched.count("hz_parties") > 1
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text


def test_supplier_parties_are_the_master_of_the_extract(spark):
    """Random vendors, sites and contacts, with nulls and repeats."""
    chance = random.Random(9)
    pick = lambda *values: chance.choice(values)
    vendors = [
        dict(vendor_id=v, vendor_name=f"V{v}", vendor_type_lookup_code=pick("VENDOR", "VENDOR", "EMPLOYEE", None), terms_id=pick(1, 2, None),
             last_updated_by=pick(1, 1, 1, 9), party_id=v)
        for v in range(60)
    ]
    erp = relations(
        spark,
        ap_suppliers=vendors,
        fnd_user=[dict(user_id=1, user_name="u")],
        ap_terms=[dict(term_id=1, name="30 Days Net"), dict(term_id=2, name=None)],
        ap_supplier_sites_all=[dict(vendor_id=chance.randrange(60), vendor_site_id=n) for n in range(50)],
        po_vendor_contacts=[
            dict(vendor_id=chance.randrange(60), phone=pick(None, "1", "2", "3"), email_address=pick(None, "a", "b", "c"))
            for _ in range(150)
        ],
    )
    master = payables.supplier_master(payables.supplier_extract(erp))
    found = payables.supplier_parties(erp)
    rows = lambda frame: sorted((tuple(r) for r in frame.select(*payables.SUPPLIER_COLUMNS).collect()), key=repr)
    assert rows(found) == rows(master) != []
    wanted = spark.createDataFrame([(3,), (4,), (None,)], "vendorId bigint")
    assert {r.vendorId for r in payables.supplier_parties(erp, wanted).collect()} <= {3, 4}
