"""Small ERP relations for tests: rows as dicts, everything not named is null."""

from __future__ import annotations

from pyspark.sql import SparkSession

from netdays.sources.relations import Relations


def _ddl(numbers: str = "", texts: str = "", **others: str) -> str:
    parts = [f"{c} bigint" for c in numbers.split()] + [f"{c} string" for c in texts.split()]
    return ", ".join(parts + [f"{c} {t}" for c, t in others.items()])


SCHEMAS = {
    "invoice_lines": _ddl(
        "customer_trx_id customer_trx_line_id inventory_item_id organization_id",
        "invoice_number invoice_currency_code ship_to_locations1",
        invoice_date="timestamp_ntz", invoice_gross_value="decimal(18,2)",
    ),
    "ra_customer_trx_all": _ddl("customer_trx_id sold_to_customer_id"),
    "ar_customers": _ddl(
        "customer_id",
        "customer_number customer_name customer_class_code status taxpayer_id tax_reference attribute4",
    ),
    "cst_item_cost_type_v": _ddl(
        "inventory_item_id organization_id cost_type_id", item_cost="decimal(12,7)"
    ),
    "mtl_descr_element_values_v": _ddl("inventory_item_id", "element_name element_value"),
    "hz_cust_accounts": _ddl(
        "cust_account_id party_id", "customer_type attribute2 attribute3 attribute10"
    ),
    "hz_cust_acct_sites_all": _ddl("cust_acct_site_id cust_account_id party_site_id"),
    "hz_cust_site_uses_all": _ddl(
        "site_use_id cust_acct_site_id payment_term_id price_list_id order_type_id primary_salesrep_id",
        "site_use_code location status freight_term attribute1 attribute2",
    ),
    "hz_party_sites": _ddl(
        "party_site_id party_id location_id", "party_site_name party_site_number attribute1"
    ),
    "hz_parties": _ddl(
        "party_id",
        "party_type party_name party_number country address1 address2 address3 address4"
        " postal_code state email_address",
        creation_date="date",
    ),
    "hz_locations": _ddl("location_id", "city province"),
    "hz_customer_profiles": _ddl(
        "cust_account_id collector_id profile_class_id",
        "credit_checking credit_hold autocash_hierarchy_id autocash_hierarchy_id_for_adr",
    ),
    "hz_cust_profile_amts": _ddl(
        "cust_account_id site_use_id", "currency_code", overall_credit_limit="decimal(20,2)"
    ),
    "hz_organization_profiles": _ddl("party_id"),
    "hz_relationships": _ddl(
        "relationship_id object_id subject_id party_id",
        "relationship_code object_type subject_type object_table_name subject_table_name",
    ),
    "hz_org_contacts": _ddl("party_relationship_id org_contact_id"),
    "hz_cust_account_roles": _ddl("cust_account_id cust_acct_site_id party_id"),
    "hz_contact_points": _ddl(
        "contact_point_id owner_table_id",
        "contact_point_type phone_country_code phone_area_code phone_number email_address status",
    ),
    "ar_contacts_v": _ddl("contact_point_id org_contact_id", "first_name last_name job_title"),
    "iby_ext_bank_accounts": _ddl(
        "ext_bank_account_id bank_id branch_id", "bank_account_num bank_account_name"
    ),
    "iby_pmt_instr_uses_all": _ddl("instrument_id ext_pmt_party_id"),
    "iby_external_payers_all": _ddl("ext_payer_id cust_account_id acct_site_use_id"),
    "ar_lookups": _ddl("", "lookup_type lookup_code meaning"),
    "oe_price_lists_active_v": _ddl("price_list_id", "price_list"),
    "oe_transaction_types_tl": _ddl("transaction_type_id", "name"),
    "ra_salesreps_all": _ddl("salesrep_id resource_id", "name"),
    "jtf_rs_defresources_v": _ddl("resource_id", "resource_name"),
    "ra_terms_tl": _ddl("term_id", "language name description"),
    "ar_collectors": _ddl("collector_id", "name"),
    "hz_cust_profile_classes": _ddl("profile_class_id", "name"),
    "ap_invoices_v": _ddl(
        "invoice_id vendor_id vendor_site_id created_by org_id",
        "vendor_number vendor_name invoice_num supplier_tax_invoice_number description"
        " invoice_currency_code credited_invoice_num po_number receipt_number",
        invoice_date="date", gl_date="date", exchange_rate="decimal(10,4)",
        distribution_total="decimal(18,2)", total_tax_amount="decimal(18,2)",
        actual_invoice_amount="decimal(18,2)",
    ),
    "ap_vendors_v": _ddl("", "vendor_number vendor_type_disp vat_registration_num"),
    "fnd_user": _ddl("user_id", "user_name"),
    "fnd_attached_documents": _ddl("", "pk1_value entity_name"),
    "ap_suppliers": _ddl(
        "vendor_id terms_id party_id last_updated_by",
        "vendor_name segment1 vendor_type_lookup_code create_debit_memo_flag vat_registration_num"
        " auto_tax_calc_flag match_option receipt_required_flag inspection_required_flag",
        creation_date="date", end_date_active="date",
    ),
    "ap_supplier_sites_all": _ddl(
        "vendor_id vendor_site_id",
        "vendor_site_code create_debit_memo_flag allow_awt_flag address_line1 address_line2"
        " address_line3 city state zip country invoice_currency_code payment_currency_code",
    ),
    "po_vendor_contacts": _ddl(
        "vendor_id",
        "title prefix first_name middle_name last_name mail_stop area_code phone email_address"
        " alt_area_code alt_phone fax_area_code fax",
    ),
    "ap_terms": _ddl("term_id", "name"),
    "iby_external_payees_all": _ddl("supplier_site_id", "bank_charge_bearer"),
    "iby_account_owners": _ddl("ext_bank_account_id account_owner_party_id"),
    "iby_ext_banks_v": _ddl("bank_party_id", "bank_name"),
    "iby_ext_bank_branches_v": _ddl(
        "bank_party_id branch_party_id", "bank_branch_name branch_number eft_swift_code"
    ),
}


def relations(spark: SparkSession, **rows: list[dict]) -> Relations:
    unknown = set(rows) - set(SCHEMAS)
    assert not unknown, unknown

    def read(name: str):
        ddl = SCHEMAS[name]
        names = [c.split()[0] for c in ddl.split(", ")]
        found = rows.get(name, [])
        assert all(set(r) <= set(names) for r in found), name
        return spark.createDataFrame([tuple(r.get(c) for c in names) for r in found], ddl)

    return read
