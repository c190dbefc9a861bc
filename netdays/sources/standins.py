"""The driver's star-schema tables seen as ERP relations and ledger tables.

Only the registered queries, the bench and the tests use this module; a real
deployment passes JDBC or parquet relations instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.functions import dates, keys, money
from netdays.sources.relations import Relations, frame_relations

AS_OF = dt.date(2001, 12, 31)
GL_FROM = dt.date(1999, 1, 1)
OFFERED_BEFORE = dt.date(2000, 1, 1)

# Terms by party number modulo 9.
CUSTOMER_TERMS = (
    "30 Days Net", "14 days net", "21 Days Net", "45 Days Net", "60 Days Net",
    "7 Days Net", "Immediate", "10000 Days Net", None,
)
SUPPLIER_TERMS = (
    "30 Days Net", "Net 15 Days Net", "20 days NET", "45 Days Net", "60 Days Net",
    "90 Days Net", "12000 Days Net", "Days Net", None,
)


def usd_rate(vendor: Column) -> Column:
    """Rates of few and of many decimal places."""
    rate = F.when(vendor % 16 == 0, "129.123456").when(vendor % 16 == 8, "0.000123456").otherwise("129.50")
    return rate.cast(money.RATE)


# Declared, so that a read needs no job to look into the files.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(number: Column, texts: tuple) -> Column:
    """Text by number modulo the number of texts."""
    return F.get(F.array(*[F.lit(t) for t in texts]), F.pmod(number, F.lit(len(texts))).cast("int"))


def currency(order_key: Column) -> Column:
    digit = order_key % 10
    return F.when(digit <= 2, "USD").when(digit == 3, "GBP").otherwise("KES")


def site_text() -> Column:
    return F.concat(F.lit(" "), F.col("n_name"), F.lit("-"), F.col("c_mktsegment"))


def customers_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf_dir, "customer").join(nation, "c_nationkey")


def as_headers(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("invoiceNumber"),
        F.col("o_orderdate").cast("date").alias("invoiceDate"),
        F.col("o_custkey").alias("customerNumber"),
        currency(F.col("o_orderkey")).alias("invoiceCurrencyCode"),
    )


def invoice_headers(
    spark: SparkSession, sf_dir: str, since: dt.date | None = None
) -> DataFrame:
    """Invoice headers, from a day on. The filter is on the stored column, so it pushes down."""
    orders = table(spark, sf_dir, "orders")
    if since is not None:
        orders = orders.filter(dates.on_or_after(F.col("o_orderdate"), since))
    return as_headers(orders)


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("invoiceNumber"),
        money.line_gross(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")).alias(
            "invoiceGrossValue"
        ),
        (
            F.col("l_linenumber") * F.lit(10**18)
            + F.col("l_partkey") * 10**7
            + F.col("l_suppkey") % 10**7
        ).alias("lineId"),
        F.col("l_partkey").alias("partKey"),
    )


LINE_ORDER = ("lineId",)


def ship_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship-to text by customer number."""
    return customers_with_nation(spark, sf_dir).select(
        F.col("c_custkey").alias("customerNumber"), site_text().alias("shipTo")
    )


def with_customer_key(headers: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = headers.join(ship_to(spark, sf_dir), "customerNumber", "left")
    return joined.withColumn(
        "customerKey", keys.party_key(F.col("shipTo"), F.col("customerNumber"))
    ).drop("shipTo")


def customers(spark: SparkSession, sf_dir: str, known: Column | None = None) -> DataFrame:
    """The ledger's customers: one row per key, all or those a condition names."""
    number = F.col("c_custkey")
    rows = customers_with_nation(spark, sf_dir)
    return (rows if known is None else rows.filter(known)).select(
        number.alias("customerId"),
        number.alias("customerNumber"),
        keys.party_key(site_text(), number).alias("customerKey"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("ar"), number.cast("string"), F.lit("@example.com")).alias("email"),
        F.lit("ORGANIZATION").alias("customerType"),
        pick(number, CUSTOMER_TERMS).alias("creditTerms"),
    )


def offered_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices that have an offer already: finished orders of the last century."""
    return (
        table(spark, sf_dir, "orders")
        .filter((F.col("o_orderdate") < F.lit(OFFERED_BEFORE)) & (F.col("o_orderstatus") == "F"))
        .select(
            F.col("o_orderkey").alias("invoiceNumber"),
            F.col("o_orderdate").cast("date").alias("invoiceDate"),
        )
    )


def payable_invoices(
    spark: SparkSession,
    sf_dir: str,
    gl_from: dt.date | None = None,
    gl_to: dt.date | None = None,
) -> DataFrame:
    """Supplier invoices as the ERP view gives them, of a GL window.

    The window is put on the stored ship date, so that it reaches the scan.
    """
    return as_payables(table(spark, sf_dir, "lineitem"), gl_from, gl_to)


def as_payables(
    lines: DataFrame, gl_from: dt.date | None = None, gl_to: dt.date | None = None
) -> DataFrame:
    """Lineitems as supplier invoices; the GL date is 3 days after the ship date."""
    shift = dt.timedelta(days=3)
    if gl_from is not None:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(gl_from - shift))
    if gl_to is not None:
        lines = lines.filter(F.col("l_shipdate") < F.lit(gl_to - shift + dt.timedelta(days=1)))
    converted = F.col("l_suppkey") % 4 == 0
    number = F.concat(
        F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
    )
    return lines.select(
        F.col("l_suppkey").alias("vendorId"),
        number.alias("invoiceNumber"),
        F.col("l_shipdate").cast("date").alias("invoiceDate"),
        F.date_add(F.col("l_shipdate").cast("date"), 3).alias("glDate"),
        money.line_gross(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")).alias("amount"),
        (F.col("l_extendedprice").cast(money.AMOUNT) * F.col("l_tax").cast(money.RATIO))
        .cast(money.LINE_GROSS)
        .alias("tax"),
        F.when(converted, "USD").otherwise("KES").alias("currency"),
        F.when(converted, usd_rate(F.col("l_suppkey"))).alias("rate"),
        F.col("l_quantity").alias("distributionTotal"),
        F.col("l_returnflag").alias("returnFlag"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger's suppliers: one row per vendor."""
    number = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        number.alias("supplierId"),
        number.alias("vendorId"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("ap"), number.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(number % 7 == 0, "EMPLOYEE").when(number % 7 != 1, "VENDOR").alias("supplierType"),
        pick(number, SUPPLIER_TERMS).alias("creditTerms"),
    )


def offered_payables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier invoices that have an offer already."""
    return (
        table(spark, sf_dir, "lineitem")
        .filter((F.col("l_shipdate") < F.lit(OFFERED_BEFORE)) & (F.col("l_linestatus") == "F"))
        .select(
            keys.invoice_key(
                F.col("l_suppkey"),
                F.concat(
                    F.col("l_orderkey").cast("string"),
                    F.lit("-"),
                    F.col("l_linenumber").cast("string"),
                ),
            ).alias("invoiceUniqueKey"),
            F.col("l_shipdate").cast("date").alias("invoiceDate"),
        )
    )


def payable_relations(spark: SparkSession, sf_dir: str) -> Relations:
    """Lineitem as the supplier invoice view, supplier as its vendors.

    The GL date is 3 days after the stored ship date. The driver's orders that
    are pending have an attached document.
    """
    lines = table(spark, sf_dir, "lineitem")
    number = F.concat(
        F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
    )
    converted = F.col("l_suppkey") % 4 == 0
    text = F.lit(None).cast("string")
    invoices = lines.select(
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_shipdate").alias("invoice_date"),
        (F.col("l_shipdate") + F.expr("INTERVAL 3 DAYS")).alias("gl_date"),
        F.col("l_suppkey").alias("vendor_id"),
        F.col("l_suppkey").alias("vendor_number"),
        text.alias("vendor_site_id"),
        text.alias("vendor_name"),
        number.alias("invoice_num"),
        text.alias("supplier_tax_invoice_number"),
        F.col("l_linenumber").alias("created_by"),
        text.alias("description"),
        F.when(converted, "USD").otherwise("KES").alias("invoice_currency_code"),
        F.when(converted, usd_rate(F.col("l_suppkey"))).alias("exchange_rate"),
        text.alias("credited_invoice_num"),
        text.alias("po_number"),
        text.alias("receipt_number"),
        F.col("l_quantity").alias("distribution_total"),
        (F.col("l_extendedprice").cast(money.AMOUNT) * F.col("l_tax").cast(money.RATIO)).alias(
            "total_tax_amount"
        ),
        money.line_gross(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")).alias(
            "actual_invoice_amount"
        ),
        F.lit(82).alias("org_id"),
    )
    vendors = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("vendor_number"),
        F.lit("VENDOR").alias("vendor_type_disp"),
        text.alias("vat_registration_num"),
    )
    users = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("user_id"), F.col("n_name").alias("user_name")
    )
    attached = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "P")
        .select(
            F.col("o_orderkey").cast("string").alias("pk1_value"),
            F.lit("AP_INVOICES").alias("entity_name"),
        )
    )
    return frame_relations(
        {
            "ap_invoices_v": invoices,
            "ap_vendors_v": vendors,
            "fnd_user": users,
            "fnd_attached_documents": attached,
        }
    )


def supplier_relations(spark: SparkSession, sf_dir: str) -> Relations:
    """Supplier as the vendor table, with sites, contacts, terms and bank accounts.

    Every part a supplier delivers stands for a bank account it owns; the brand
    is its bank and the type its branch. One brand is in no bank list.
    """
    supplier = table(spark, sf_dir, "supplier")
    number = F.col("s_suppkey")
    two = F.explode(F.array(F.lit(0), F.lit(1))).alias("k")
    text = F.lit(None).cast("string")

    def flag(divisor: int) -> Column:
        return F.when(number % divisor == 0, "Y").when(number % divisor == 1, "N")

    vendors = supplier.select(
        number.alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        number.cast("string").alias("segment1"),
        F.when(number % 7 == 0, "EMPLOYEE").when(number % 7 != 1, "VENDOR").alias(
            "vendor_type_lookup_code"
        ),
        F.lit(None).cast("date").alias("creation_date"),
        F.lit(None).cast("date").alias("end_date_active"),
        text.alias("create_debit_memo_flag"),
        (number % len(SUPPLIER_TERMS)).alias("terms_id"),
        text.alias("vat_registration_num"),
        F.coalesce(flag(3), F.lit("X")).alias("auto_tax_calc_flag"),
        number.alias("party_id"),
        text.alias("match_option"),
        flag(3).alias("receipt_required_flag"),
        flag(4).alias("inspection_required_flag"),
        F.col("s_nationkey").alias("last_updated_by"),
    )
    sites = (
        supplier.select(number, two)
        .filter((number % 5 != 4) & ((F.col("k") == 0) | (number % 2 == 0)))
        .select(
            number.alias("vendor_id"),
            (number * 2 + F.col("k")).alias("vendor_site_id"),
            *[
                text.alias(c)
                for c in (
                    "vendor_site_code", "create_debit_memo_flag", "allow_awt_flag",
                    "address_line1", "address_line2", "address_line3", "city", "state", "zip",
                    "country", "invoice_currency_code", "payment_currency_code",
                )
            ],
        )
    )
    contacts = (
        supplier.select(number, two)
        .filter(number % 4 != 3)
        .select(
            number.alias("vendor_id"),
            text.alias("title"),
            F.lit("Mr").alias("prefix"),
            F.lit("F").alias("first_name"),
            F.when(number % 3 != 0, "Q").alias("middle_name"),
            F.lit("L").alias("last_name"),
            F.concat(F.lit("555-"), number, F.lit("-"), F.col("k")).alias("phone"),
            F.concat(F.lit("c"), number, F.lit("."), F.col("k"), F.lit("@example.com")).alias(
                "email_address"
            ),
            *[
                text.alias(c)
                for c in (
                    "mail_stop", "area_code", "alt_area_code", "alt_phone", "fax_area_code", "fax",
                )
            ],
        )
    )
    terms = spark.range(len(SUPPLIER_TERMS)).select(
        F.col("id").alias("term_id"), pick(F.col("id"), SUPPLIER_TERMS).alias("name")
    )
    owners = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("ext_bank_account_id"),
        F.col("l_suppkey").alias("account_owner_party_id"),
    )
    part = table(spark, sf_dir, "part")
    accounts = part.select(
        F.col("p_partkey").alias("ext_bank_account_id"),
        F.col("p_brand").alias("bank_id"),
        F.col("p_type").alias("branch_id"),
        F.concat(F.lit("ACC"), F.col("p_partkey")).alias("bank_account_num"),
        F.col("p_name").alias("bank_account_name"),
    )
    listed = part.filter(F.col("p_brand") != "Brand#1").select("p_brand", "p_type").distinct()
    return frame_relations(
        {
            "ap_suppliers": vendors,
            "ap_supplier_sites_all": sites,
            "po_vendor_contacts": contacts,
            "ap_terms": terms,
            "fnd_user": table(spark, sf_dir, "nation").select(
                F.col("n_nationkey").alias("user_id"), F.col("n_name").alias("user_name")
            ),
            "iby_external_payees_all": sites.select(
                F.col("vendor_site_id").alias("supplier_site_id"),
                F.lit("OUR").alias("bank_charge_bearer"),
            ),
            "iby_account_owners": owners,
            "iby_ext_bank_accounts": accounts,
            "iby_ext_banks_v": listed.select(
                F.col("p_brand").alias("bank_party_id"), F.col("p_brand").alias("bank_name")
            ).distinct(),
            "iby_ext_bank_branches_v": listed.select(
                F.col("p_brand").alias("bank_party_id"),
                F.col("p_type").alias("branch_party_id"),
                F.col("p_type").alias("bank_branch_name"),
                F.lit(None).cast("string").alias("branch_number"),
                F.lit(None).cast("string").alias("eft_swift_code"),
            ),
        }
    )


# Party id ranges of the customer stand-in, so that kinds of parties do not meet.
PERSON, BANK, BRANCH, ROLE, RELATION = (n * 10**12 for n in range(1, 6))


def customer_relations(spark: SparkSession, sf_dir: str) -> Relations:
    """Customer, nation and orders as the ERP's customer master.

    A site of a customer is an order priority it has used; each site has two
    uses, of which the terms differ. Every order stands for a bank account of
    the first use of its site, held at one of the nations' banks.
    """
    people = customers_with_nation(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation")
    number = F.col("c_custkey")
    digit = F.substring("o_orderpriority", 1, 1).cast("bigint")
    site = F.col("o_custkey") * 10 + digit
    text = F.lit(None).cast("string")

    def texts(*names: str) -> list[Column]:
        return [text.alias(c) for c in names]

    used = orders.select("o_custkey", "o_orderpriority").distinct()
    sites = used.select(
        site.alias("cust_acct_site_id"),
        F.col("o_custkey").alias("cust_account_id"),
        site.alias("party_site_id"),
    )
    uses = (
        used.join(people, F.col("o_custkey") == number)
        .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
        .select(
            (site * 2 + F.col("k")).alias("site_use_id"),
            site.alias("cust_acct_site_id"),
            F.when(F.col("k") == 0, "BILL_TO").otherwise("SHIP_TO").alias("site_use_code"),
            F.concat(F.lit(" "), "n_name", F.lit("-"), "o_orderpriority").alias("location"),
            F.when((number + digit) % 11 == 0, "I").otherwise("A").alias("status"),
            ((number + F.col("k")) % len(CUSTOMER_TERMS)).alias("payment_term_id"),
            F.lit(None).cast("bigint").alias("price_list_id"),
            F.lit(None).cast("bigint").alias("order_type_id"),
            F.col("c_nationkey").alias("primary_salesrep_id"),
            *texts("freight_term", "attribute1", "attribute2"),
        )
    )
    organizations = people.select(
        number.alias("party_id"),
        F.lit("ORGANIZATION").alias("party_type"),
        F.col("c_name").alias("party_name"),
        F.date_add(F.lit(dt.date(2014, 1, 1)), (number % 3650).cast("int")).alias("creation_date"),
        F.when(number % 10 != 0, F.concat(F.lit("ar"), number, F.lit("@example.com"))).alias(
            "email_address"
        ),
    )
    persons = people.select(
        (number + PERSON).alias("party_id"), F.lit("PERSON").alias("party_type")
    )
    banks = nation.select(
        (F.col("n_nationkey") + BANK).alias("party_id"),
        F.lit("ORGANIZATION").alias("party_type"),
        F.concat(F.lit("BANK "), "n_name").alias("party_name"),
    )
    branches = nation.select(
        (F.col("n_nationkey") + BRANCH).alias("party_id"),
        F.lit("ORGANIZATION").alias("party_type"),
        F.concat(F.lit("BRANCH "), "n_name").alias("party_name"),
    )
    parties = organizations
    for more in (persons, banks, branches):
        parties = parties.unionByName(more, allowMissingColumns=True)
    parties = parties.select(
        "*",
        *texts(
            "party_number", "country", "address1", "address2", "address3", "address4",
            "postal_code", "state",
        ),
    )
    related = people.filter(number % 6 != 5)
    contact_relations = related.select(
        number.alias("relationship_id"),
        number.alias("object_id"),
        (number + PERSON).alias("subject_id"),
        (number + RELATION).alias("party_id"),
        F.lit("CONTACT_OF").alias("relationship_code"),
        *texts("object_type", "subject_type", "object_table_name", "subject_table_name"),
    )
    branch_relations = nation.select(
        (-1 - F.col("n_nationkey")).cast("bigint").alias("relationship_id"),
        (F.col("n_nationkey") + BANK).alias("object_id"),
        (F.col("n_nationkey") + BRANCH).alias("subject_id"),
        F.lit(None).cast("bigint").alias("party_id"),
        F.lit("BRANCH_OF").alias("relationship_code"),
        F.lit("ORGANIZATION").alias("object_type"),
        F.lit("ORGANIZATION").alias("subject_type"),
        F.lit("HZ_PARTIES").alias("object_table_name"),
        F.lit("HZ_PARTIES").alias("subject_table_name"),
    )
    roles = used.filter(digit != 5).select(
        F.col("o_custkey").alias("cust_account_id"),
        site.alias("cust_acct_site_id"),
        (site + ROLE).alias("party_id"),
    )
    kinds = F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("k")
    role_points = roles.select(F.col("party_id").alias("owner"), "cust_account_id", kinds)
    is_email = F.col("k") == 2
    point_id = F.col("owner") * 4 + F.col("k")
    contact_points = role_points.select(
        point_id.alias("contact_point_id"),
        F.col("owner").alias("owner_table_id"),
        F.when(is_email, "EMAIL").otherwise("PHONE").alias("contact_point_type"),
        F.when(~is_email, "254").alias("phone_country_code"),
        F.when(~is_email & (F.col("cust_account_id") % 2 == 0), "20").alias("phone_area_code"),
        F.when(~is_email, F.concat(F.col("cust_account_id"), F.lit("/"), F.col("k"))).alias(
            "phone_number"
        ),
        F.when(is_email, F.concat(F.lit("p"), F.col("cust_account_id"), F.lit("@example.com"))).alias(
            "email_address"
        ),
        F.lit("A").alias("status"),
    ).unionByName(
        related.filter(number % 4 != 3).select(
            (-number).alias("contact_point_id"),
            (number + RELATION).alias("owner_table_id"),
            F.lit("WEB").alias("contact_point_type"),
            *texts("phone_country_code", "phone_area_code", "phone_number", "email_address"),
            F.lit("A").alias("status"),
        )
    )
    contacts = role_points.select(
        point_id.alias("contact_point_id"),
        F.col("cust_account_id").alias("org_contact_id"),
        F.concat(F.lit("First"), F.col("cust_account_id")).alias("first_name"),
        F.when(F.col("cust_account_id") % 3 != 0, F.concat(F.lit("Last"), F.col("k"))).alias("last_name"),
        F.concat(F.lit("Job"), F.col("k")).alias("job_title"),
    )
    first_use = site * 2
    limits = uses.select(
        F.floor(F.col("cust_acct_site_id") / 10).alias("cust_account_id"),
        "site_use_id",
        F.explode(F.array(F.lit("KES"), F.lit("USD"))).alias("currency_code"),
    ).select(
        "*",
        (F.col("cust_account_id") * F.when(F.col("currency_code") == "KES", 100).otherwise(1))
        .cast(money.CREDIT)
        .alias("overall_credit_limit"),
    )
    nations = F.col("n_nationkey")
    return frame_relations(
        {
            "ar_customers": people.select(
                number.alias("customer_id"),
                number.cast("string").alias("customer_number"),
                F.col("c_name").alias("customer_name"),
                F.col("c_mktsegment").alias("customer_class_code"),
                F.when(number % 13 == 0, "I").otherwise("A").alias("status"),
                *texts("taxpayer_id", "tax_reference", "attribute4"),
            ),
            "hz_cust_accounts": people.select(
                number.alias("cust_account_id"),
                number.alias("party_id"),
                pick(number, ("R", "I", "X")).alias("customer_type"),
                *texts("attribute2", "attribute3", "attribute10"),
            ),
            "hz_cust_acct_sites_all": sites,
            "hz_cust_site_uses_all": uses,
            "hz_party_sites": used.select(
                site.alias("party_site_id"),
                # Some sites belong to another party than the account's.
                F.when((digit == 3) & (F.col("o_custkey") % 5 == 1), -1).otherwise(F.col("o_custkey")).alias("party_id"),
                digit.alias("location_id"),
                F.col("o_orderpriority").alias("party_site_name"),
                *texts("party_site_number", "attribute1"),
            ),
            "hz_parties": parties,
            "hz_locations": spark.range(10).select(
                F.col("id").alias("location_id"), *texts("city", "province")
            ),
            "hz_customer_profiles": people.select(
                number.alias("cust_account_id"),
                pick(number, ("Y", "N")).alias("credit_checking"),
                F.col("c_nationkey").alias("collector_id"),
                F.col("c_nationkey").alias("profile_class_id"),
                *texts("credit_hold", "autocash_hierarchy_id", "autocash_hierarchy_id_for_adr"),
            ),
            "hz_cust_profile_amts": limits,
            "hz_organization_profiles": banks.unionByName(branches).select("party_id"),
            "hz_relationships": contact_relations.unionByName(branch_relations),
            "hz_org_contacts": related.select(
                number.alias("party_relationship_id"), number.alias("org_contact_id")
            ),
            "hz_cust_account_roles": roles,
            "hz_contact_points": contact_points,
            "ar_contacts_v": contacts,
            "iby_ext_bank_accounts": orders.select(
                F.col("o_orderkey").alias("ext_bank_account_id"),
                (F.col("o_orderkey") % 25 + BANK).alias("bank_id"),
                (F.col("o_orderkey") % 25 + BRANCH).alias("branch_id"),
                F.concat(F.lit("ACC"), "o_orderkey").alias("bank_account_num"),
            ),
            "iby_pmt_instr_uses_all": orders.select(
                F.col("o_orderkey").alias("instrument_id"), first_use.alias("ext_pmt_party_id")
            ),
            "iby_external_payers_all": used.select(
                first_use.alias("ext_payer_id"),
                F.col("o_custkey").alias("cust_account_id"),
                first_use.alias("acct_site_use_id"),
            ),
            "ar_lookups": spark.range(1).selectExpr(
                "stack(3, 'SITE_USE_CODE', 'BILL_TO', 'Bill To Site',"
                " 'SITE_USE_CODE', 'SHIP_TO', 'Ship To Site', 'CODE_STATUS', 'BILL_TO', 'Other')"
                " AS (lookup_type, lookup_code, meaning)"
            ),
            "oe_price_lists_active_v": nation.select(
                nations.cast("bigint").alias("price_list_id"), F.col("n_name").alias("price_list")
            ),
            "oe_transaction_types_tl": nation.select(
                nations.cast("bigint").alias("transaction_type_id"), F.col("n_name").alias("name")
            ),
            "ra_salesreps_all": nation.select(
                nations.alias("salesrep_id"),
                F.concat(F.lit("REP "), "n_name").alias("name"),
                nations.alias("resource_id"),
            ),
            "jtf_rs_defresources_v": nation.select(
                nations.alias("resource_id"), F.concat(F.lit("RES "), "n_name").alias("resource_name")
            ),
            "ra_terms_tl": spark.range(len(CUSTOMER_TERMS)).select(
                F.col("id").alias("term_id"),
                F.lit("US").alias("language"),
                pick(F.col("id"), CUSTOMER_TERMS).alias("name"),
                text.alias("description"),
            ),
            "ar_collectors": nation.select(
                nations.alias("collector_id"), F.concat(F.lit("COL "), "n_name").alias("name")
            ),
            "hz_cust_profile_classes": nation.select(
                nations.alias("profile_class_id"), F.concat(F.lit("CLASS "), "n_name").alias("name")
            ),
        }
    )


def receivable_relations(spark: SparkSession, sf_dir: str) -> Relations:
    """The customer master and, as flat invoice lines, orders with their lineitems.

    An invoice ships to the site of its customer that its priority names.
    """
    master = customer_relations(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    nations = customers_with_nation(spark, sf_dir).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    headers = orders.join(nations, "o_custkey").select(
        F.col("o_orderkey").alias("invoiceNumber"),
        "o_orderdate",
        F.concat(F.lit(" "), "n_name", F.lit("-"), "o_orderpriority").alias("shipTo"),
    )
    lines = headers.join(invoice_lines(spark, sf_dir), "invoiceNumber").select(
        F.col("invoiceNumber").alias("customer_trx_id"),
        F.col("lineId").alias("customer_trx_line_id"),
        F.col("invoiceNumber").cast("string").alias("invoice_number"),
        F.col("o_orderdate").alias("invoice_date"),
        F.col("invoiceGrossValue").alias("invoice_gross_value"),
        currency(F.col("invoiceNumber")).alias("invoice_currency_code"),
        F.col("shipTo").alias("ship_to_locations1"),
        F.col("partKey").alias("inventory_item_id"),
        F.lit(1).cast("bigint").alias("organization_id"),
    )
    part = table(spark, sf_dir, "part")
    headers_only = orders.select(
        F.col("o_orderkey").alias("customer_trx_id"), F.col("o_custkey").alias("sold_to_customer_id")
    )
    own = {
        "invoice_lines": lines,
        "ra_customer_trx_all": headers_only,
        "cst_item_cost_type_v": part.select(
            F.col("p_partkey").alias("inventory_item_id"),
            F.lit(1).cast("bigint").alias("organization_id"),
            F.lit(2).alias("cost_type_id"),
            F.when(F.col("p_brand") == "Brand#1", F.lit(0).cast(money.AMOUNT))
            .otherwise(F.col("p_retailprice").cast(money.AMOUNT))
            .alias("item_cost"),
        ),
        "mtl_descr_element_values_v": part.select(
            F.col("p_partkey").alias("inventory_item_id"),
            F.expr(
                "stack(3, 'Product Code', p_name, 'Size', cast(p_size AS string),"
                " 'Sub Variant', p_type) AS (element_name, element_value)"
            ),
        ),
    }
    return lambda name: own[name] if name in own else master(name)


def supplier_side_relations(spark: SparkSession, sf_dir: str) -> Relations:
    """Supplier invoices and the supplier master together."""
    invoices = payable_relations(spark, sf_dir)
    master = supplier_relations(spark, sf_dir)
    own = ("ap_invoices_v", "ap_vendors_v", "fnd_attached_documents")
    return lambda name: invoices(name) if name in own else master(name)
