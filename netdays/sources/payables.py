"""Payables extracts from the ERP: supplier invoices and supplier sites."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.functions import codes, dates, money
from netdays.operators import lookups
from netdays.operators.consolidate import one_row_per_party
from netdays.operators.incremental import only_keys
from netdays.sources.relations import Relations, prefixed

SUPPLIER_COLUMNS = ("vendorId", "supplierName", "supplierType", "creditTerms", "phone", "email")


def add_amounts(invoices: DataFrame) -> DataFrame:
    """Flags and amounts. Needs ``amount, tax, currency, rate, distributionTotal``.

    ``exclusive`` keeps an amount without tax; the base-currency exclusive amount
    is null when the tax is.
    """
    amount, tax = F.col("amount"), F.col("tax")
    currency, rate = F.col("currency"), F.col("rate")
    return invoices.withColumns(
        {
            "distributionFlag": money.distribution_flag(F.col("distributionTotal")),
            "exclusive": money.tax_exclusive(amount, tax),
            "exclusiveBase": money.in_base_currency((amount - tax).cast(money.LINE_GROSS), currency, rate),
            "taxBase": money.in_base_currency(tax, currency, rate),
            "inclusiveBase": money.in_base_currency(amount, currency, rate),
        }
    )


# Columns of the invoice view that are passed on under another name.
_PASSED = {
    "vendorSiteId": "vendor_site_id",
    "vendorNumber": "vendor_number",
    "supplierName": "vendor_name",
    "invoiceNumber": "invoice_num",
    "controlUnitInvoiceNumber": "supplier_tax_invoice_number",
    "itemDescription": "description",
    "currency": "invoice_currency_code",
    "creditedInvoiceNumber": "credited_invoice_num",
    "poNumber": "po_number",
    "receiptNumber": "receipt_number",
    "distributionTotal": "distribution_total",
}
# What an offer needs of an invoice.
OFFER_INPUT = ("vendorId", "invoiceNumber", "invoiceDate", "glDate", "amount", "currency", "rate")


def invoice_extract(
    relations: Relations,
    gl_from: dt.date,
    gl_to: dt.date,
    org_id: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Supplier invoices with a GL date in a closed window, of one operating unit.

    Only invoices of known vendors. Fewer ``columns`` mean fewer look-ups: the
    creator's name and the attachment flag are joined only if wanted.
    """
    ap = relations("ap_invoices_v").filter(dates.in_closed_window(F.col("gl_date"), gl_from, gl_to))
    if org_id is not None:
        ap = ap.filter(F.col("org_id") == org_id)
    vendors = relations("ap_vendors_v").select(
        "vendor_number",
        F.col("vendor_type_disp").alias("vendorType"),
        F.col("vat_registration_num").alias("vatNumber"),
    )
    joined = ap.join(vendors, "vendor_number")
    if columns is None or "createdBy" in columns:
        users = relations("fnd_user").select(
            F.col("user_id").alias("created_by"), F.col("user_name").alias("createdBy")
        )
        joined = lookups.look_up(joined, users, "created_by")
    if columns is None or "attachments" in columns:
        attached = (
            relations("fnd_attached_documents")
            .filter(F.col("entity_name") == "AP_INVOICES")
            .select(F.col("pk1_value").try_cast("bigint").alias("invoice_id"))
        )
        joined = lookups.membership_flag(
            joined, attached, "invoice_id", "attachments", spread_by=["vendor_id", "invoice_num"]
        )
    made = {new: F.col(old) for new, old in _PASSED.items()} | {
        "invoiceDate": F.col("invoice_date").cast("date"),
        "glDate": F.col("gl_date").cast("date"),
        "vendorId": F.col("vendor_id").cast("bigint"),
        "rate": F.col("exchange_rate").cast(money.RATE),
        "tax": F.col("total_tax_amount").cast(money.LINE_GROSS),
        "amount": F.col("actual_invoice_amount").cast(money.LINE_GROSS),
    }
    looked_up = [c for c in ("vendorType", "vatNumber", "createdBy", "attachments") if c in joined.columns]
    extract = joined.select(*[c.alias(n) for n, c in made.items()], *looked_up).transform(add_amounts)
    return extract if columns is None else extract.select(*columns)


def supplier_banks(relations: Relations) -> DataFrame:
    """Bank, branch, branch number and SWIFT code of a party's first complete account."""
    accounts = relations("iby_ext_bank_accounts").select(
        "ext_bank_account_id",
        F.col("bank_id").alias("bank_party_id"),
        F.col("branch_id").alias("branch_party_id"),
    )
    owners = relations("iby_account_owners").select(
        "ext_bank_account_id", F.col("account_owner_party_id").alias("aps_party_id")
    )
    banks = relations("iby_ext_banks_v").select("bank_party_id", F.col("bank_name").alias("bankName"))
    branches = relations("iby_ext_bank_branches_v").select(
        "bank_party_id", "branch_party_id",
        F.col("bank_branch_name").alias("bankBranchName"),
        F.col("branch_number").alias("branchNumber"),
        F.col("eft_swift_code").alias("swiftCode"),
    )
    joined = (
        accounts.join(owners, "ext_bank_account_id")
        .join(banks, "bank_party_id")
        .join(branches, ["bank_party_id", "branch_party_id"])
    )
    return lookups.first_match(
        joined,
        keys=["aps_party_id"],
        order=["ext_bank_account_id", "bankName", "bankBranchName"],
        columns=["bankName", "bankBranchName", "branchNumber", "swiftCode"],
    )


def supplier_accounts(relations: Relations) -> DataFrame:
    """Account number and name of a party's first account, whatever its bank."""
    accounts = relations("iby_ext_bank_accounts").select(
        "ext_bank_account_id",
        F.col("bank_account_num").alias("bankAccountNumber"),
        F.col("bank_account_name").alias("bankAccountName"),
    )
    owners = relations("iby_account_owners").select(
        "ext_bank_account_id", F.col("account_owner_party_id").alias("aps_party_id")
    )
    return lookups.first_match(
        accounts.join(owners, "ext_bank_account_id"),
        keys=["aps_party_id"],
        order=["ext_bank_account_id"],
        columns=["bankAccountNumber", "bankAccountName"],
    )


def supplier_extract(relations: Relations, vendor_ids: DataFrame | None = None) -> DataFrame:
    """Suppliers other than employees, with sites, contacts, terms and bank.

    A null supplier type drops out as well. Contacts belong to the vendor, so
    sites and contacts of one vendor multiply, as the extract's readers expect.
    """
    vendors = relations("ap_suppliers").filter(F.col("vendor_type_lookup_code") != "EMPLOYEE")
    if vendor_ids is not None:
        vendors = only_keys(vendors, vendor_ids.select(F.col("vendorId").alias("vendor_id")), "vendor_id")
    aps = prefixed(
        vendors, "aps",
        ["vendor_id", "vendor_name", "segment1", "vendor_type_lookup_code", "creation_date",
         "end_date_active", "create_debit_memo_flag", "terms_id", "vat_registration_num",
         "auto_tax_calc_flag", "party_id", "match_option", "receipt_required_flag",
         "inspection_required_flag", "last_updated_by"],
    )
    apss = prefixed(
        relations("ap_supplier_sites_all"), "apss",
        ["vendor_id", "vendor_site_id", "vendor_site_code", "create_debit_memo_flag",
         "allow_awt_flag", "address_line1", "address_line2", "address_line3", "city", "state",
         "zip", "country", "invoice_currency_code", "payment_currency_code"],
    )
    pvc = prefixed(
        relations("po_vendor_contacts"), "pvc",
        ["vendor_id", "title", "prefix", "first_name", "middle_name", "last_name", "mail_stop",
         "area_code", "phone", "email_address", "alt_area_code", "alt_phone", "fax_area_code", "fax"],
    )
    terms = relations("ap_terms").select(
        F.col("term_id").alias("aps_terms_id"), F.col("name").alias("creditTerms")
    )
    users = relations("fnd_user").select(
        F.col("user_id").alias("aps_last_updated_by"), F.col("user_name").alias("userName")
    )
    bearers = relations("iby_external_payees_all").select(
        F.col("supplier_site_id").alias("apss_vendor_site_id"),
        F.col("bank_charge_bearer").alias("bankChargeBearer"),
    )
    joined = (
        aps.join(users, "aps_last_updated_by")
        .join(apss, F.col("aps_vendor_id") == F.col("apss_vendor_id"), "left")
        .join(pvc, F.col("apss_vendor_id") == F.col("pvc_vendor_id"), "left")
    )
    joined = lookups.look_up(joined, terms, "aps_terms_id")
    joined = lookups.look_up(joined, bearers, "apss_vendor_site_id")
    # A supplier without a site has no bank in the extract.
    has_site = F.col("apss_vendor_id").isNotNull()
    for table in (supplier_banks(relations), supplier_accounts(relations)):
        names = [c for c in table.columns if c != "aps_party_id"]
        joined = lookups.look_up(joined, table, "aps_party_id").withColumns(
            {c: F.when(has_site, F.col(c)) for c in names}
        )
    passed = (
        ("aps_vendor_id", "vendorId"), ("aps_end_date_active", "endDateActive"),
        ("aps_vendor_name", "supplierName"), ("aps_creation_date", "creationDate"),
        ("aps_segment1", "supplierNumber"), ("aps_vendor_type_lookup_code", "supplierType"),
        ("apss_vendor_site_id", "vendorSiteId"), ("apss_vendor_site_code", "supplierSite"),
        ("apss_create_debit_memo_flag", "siteDebitMemoFlag"),
        ("aps_create_debit_memo_flag", "debitMemoFlag"), ("aps_terms_id", "termsId"),
        ("aps_vat_registration_num", "taxNumber"), ("apss_allow_awt_flag", "allowAwtFlag"),
        ("aps_party_id", "partyId"), ("pvc_title", "title"), ("pvc_mail_stop", "mailStop"),
        ("pvc_area_code", "areaCode"), ("pvc_phone", "phone"), ("pvc_email_address", "email"),
        ("pvc_alt_area_code", "altAreaCode"), ("pvc_alt_phone", "altPhone"),
        ("pvc_fax_area_code", "faxAreaCode"), ("pvc_fax", "fax"),
        ("apss_address_line1", "addressLine1"), ("apss_address_line2", "addressLine2"),
        ("apss_address_line3", "addressLine3"), ("apss_city", "city"), ("apss_state", "state"),
        ("apss_zip", "zip"), ("apss_country", "country"),
        ("apss_invoice_currency_code", "invoiceCurrency"),
        ("apss_payment_currency_code", "paymentCurrency"), ("aps_match_option", "matchOption"),
        ("aps_receipt_required_flag", "receiptRequiredFlag"),
        ("aps_inspection_required_flag", "inspectionRequiredFlag"),
    )
    return joined.select(
        *[F.col(old).alias(new) for old, new in passed],
        "userName", "creditTerms", "bankChargeBearer",
        "bankName", "bankBranchName", "branchNumber", "swiftCode",
        "bankAccountNumber", "bankAccountName",
        codes.decode(F.col("aps_auto_tax_calc_flag"), codes.YES_NO).alias("autoCalculateTaxFlag"),
        codes.join_text(
            " ", F.col("pvc_prefix"), F.col("pvc_first_name"),
            F.col("pvc_middle_name"), F.col("pvc_last_name"),
        ).alias("contactName"),
        codes.matching_level(
            F.col("aps_receipt_required_flag"), F.col("aps_inspection_required_flag")
        ).alias("matchingLevel"),
    )


def supplier_parties(relations: Relations, vendor_ids: DataFrame | None = None) -> DataFrame:
    """:func:`supplier_master` of the extract, without its sites times contacts.

    Contacts are reduced to one row per vendor before anything is joined, of sites it
    only matters whether there is one, and no bank is looked up.
    """
    vendors = relations("ap_suppliers").filter(F.col("vendor_type_lookup_code") != "EMPLOYEE")
    if vendor_ids is not None:
        vendors = only_keys(vendors, vendor_ids.select(F.col("vendorId").alias("vendor_id")), "vendor_id")
    users = relations("fnd_user").select(F.col("user_id").alias("last_updated_by"))
    terms = relations("ap_terms").select(F.col("term_id").alias("terms_id"), F.col("name").alias("creditTerms"))
    named = vendors.join(users, "last_updated_by", "left_semi").join(terms, "terms_id", "left").select(
        F.col("vendor_id").alias("vendorId"),
        F.col("vendor_name").alias("supplierName"),
        F.col("vendor_type_lookup_code").alias("supplierType"),
        "creditTerms",
    )
    has_site = relations("ap_supplier_sites_all").select(F.col("vendor_id").alias("vendorId"))
    contacts = (
        relations("po_vendor_contacts")
        .select(F.col("vendor_id").alias("vendorId"), "phone", F.col("email_address").alias("email"))
        .groupBy("vendorId")
        .agg(
            F.min("phone").alias("phone"),
            F.min_by("email", F.when(F.col("email").isNotNull(), F.struct("phone", "email"))).alias("email"),
        )
        .join(has_site, "vendorId", "left_semi")
    )
    firsts = [c for c in SUPPLIER_COLUMNS if c != "vendorId"]
    return one_row_per_party(named.join(contacts, "vendorId", "left"), "vendorId", firsts, ["phone", "email"])


def supplier_rows(extract: DataFrame) -> DataFrame:
    """The six canonical columns, exact repeats removed; a vendor may still repeat."""
    return extract.select(*SUPPLIER_COLUMNS).distinct()


def supplier_master(extract: DataFrame) -> DataFrame:
    """One row per vendor, so that a join to invoices keeps their count.

    Only contacts differ within a vendor, so they give the order. No distinct
    comes first: repeats do not change a minimum.
    """
    firsts = [c for c in SUPPLIER_COLUMNS if c != "vendorId"]
    return one_row_per_party(
        extract.select(*SUPPLIER_COLUMNS), "vendorId", firsts, ["phone", "email"]
    )
