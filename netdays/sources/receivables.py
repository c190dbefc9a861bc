"""Receivables extracts from the ERP: invoice lines and customer sites.

Relation and column names are those of the ERP, in lower case. Every optional
look-up is a join to one row per key, so a caller that selects few columns pays
for few joins: the optimizer removes the left joins it does not read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netdays.functions import codes, dates, keys
from netdays.operators import lookups
from netdays.operators.consolidate import one_row_per_party
from netdays.operators.incremental import only_keys
from netdays.operators.joins import spread_left_join
from netdays.session import written
from netdays.sources.relations import Relations, prefixed

INVOICE_COLUMNS = (
    "invoiceNumber", "invoiceDate", "customerNumber", "invoiceGrossValue",
    "invoiceCurrencyCode", "customerKey",
)
LINE_ORDER = ("lineId",)
# Relations worth staging: small ones, which are broadcast once their size is known, and those
# that a customer extract reads more than once.
STAGED = (
    "ar_lookups", "ra_terms_tl", "ar_collectors", "hz_cust_profile_classes",
    "oe_price_lists_active_v", "oe_transaction_types_tl", "ra_salesreps_all",
    "jtf_rs_defresources_v", "hz_relationships", "hz_contact_points", "hz_cust_account_roles",
    "hz_cust_accounts", "hz_cust_site_uses_all", "hz_cust_acct_sites_all",
    "hz_org_contacts", "hz_organization_profiles", "hz_party_sites", "hz_customer_profiles",
    "hz_cust_profile_amts", "iby_external_payers_all", "ar_contacts_v", "ar_customers",
)

CUSTOMER_COLUMNS = (
    "customerNumber", "name", "email", "phone", "customerType", "creditTerms", "location", "customerKey",
)


def invoice_lines(relations: Relations, since: dt.date) -> DataFrame:
    """Invoice lines from a day on, with customer number and key.

    The transaction-line relation gives no column and could only repeat rows
    that are summed later, so it is not joined. Headers get their customer
    number first, so that the lines are joined, and moved, only once.
    """
    lines = relations("invoice_lines").filter(dates.on_or_after(F.col("invoice_date"), since))
    headers = relations("ra_customer_trx_all").select("customer_trx_id", "sold_to_customer_id")
    customers = relations("ar_customers").select(
        F.col("customer_id").alias("sold_to_customer_id"),
        keys.number_text(F.col("customer_number")).alias("customerNumber"),
    )
    numbers = headers.join(customers, "sold_to_customer_id", "left").drop("sold_to_customer_id")
    return lines.join(numbers, "customer_trx_id", "left").select(
        F.col("invoice_number").alias("invoiceNumber"),
        F.col("customer_trx_line_id").alias("lineId"),
        F.col("invoice_date").cast("date").alias("invoiceDate"),
        "customerNumber",
        F.col("invoice_gross_value").cast("decimal(18,2)").alias("invoiceGrossValue"),
        F.col("invoice_currency_code").alias("invoiceCurrencyCode"),
        keys.party_key(F.col("ship_to_locations1"), F.col("customerNumber")).alias("customerKey"),
        F.col("inventory_item_id").alias("itemId"),
        F.col("organization_id").alias("organizationId"),
    )


def with_item_details(lines: DataFrame, relations: Relations, on_repeat: str = "raise") -> DataFrame:
    """Unit cost and the five named item attributes of each line.

    An item should have one cost per organization; two different ones are an error, or with
    ``reject`` no cost, so the number of lines never changes.
    """
    costs = relations("cst_item_cost_type_v").select(
        F.col("inventory_item_id").alias("itemId"),
        F.col("organization_id").alias("organizationId"),
        F.col("item_cost").alias("itemCost"),
        F.col("cost_type_id").alias("costTypeId"),
    )
    pairs = relations("mtl_descr_element_values_v").select(
        F.col("inventory_item_id").alias("itemId"),
        F.col("element_name").alias("elementName"),
        F.col("element_value").alias("elementValue"),
    )
    item = ["itemId", "organizationId"]
    cost = lookups.single_row(lookups.nonzero_unit_cost(costs), item, ["unitCost"], on_repeat)
    with_cost = spread_left_join(lines, cost, item, ["lineId"])
    return spread_left_join(with_cost, lookups.item_attributes(pairs), ["itemId"], ["lineId"])


def customer_sites(relations: Relations, customer_numbers: DataFrame | None = None) -> DataFrame:
    """Active sites of active customers, optionally of a list of numbers only.

    Numbers stay text here, as some are no numbers; the ledger holds them as such.
    """
    customers = relations("ar_customers").filter(F.col("status") == "A")
    if customer_numbers is not None:
        wanted = customer_numbers.select(F.col("customerNumber").alias("customer_number"))
        customers = only_keys(customers, wanted, "customer_number")
    ac = prefixed(
        customers, "ac",
        ["customer_id", "customer_number", "customer_name", "customer_class_code", "status",
         "taxpayer_id", "tax_reference", "attribute4"],
    )
    hca = prefixed(
        relations("hz_cust_accounts"), "hca",
        ["cust_account_id", "party_id", "customer_type", "attribute2", "attribute3", "attribute10"],
    )
    hcas = prefixed(
        relations("hz_cust_acct_sites_all"), "hcas",
        ["cust_acct_site_id", "cust_account_id", "party_site_id"],
    )
    hcsu = prefixed(
        relations("hz_cust_site_uses_all").filter(F.col("status") == "A"), "hcsu",
        ["site_use_id", "cust_acct_site_id", "site_use_code", "location", "status",
         "payment_term_id", "price_list_id", "order_type_id", "primary_salesrep_id",
         "freight_term", "attribute1", "attribute2"],
    )
    hps = prefixed(
        relations("hz_party_sites"), "hps",
        ["party_site_id", "party_id", "location_id", "party_site_name", "party_site_number", "attribute1"],
    )
    hp = prefixed(
        relations("hz_parties"), "hp",
        ["party_id", "party_type", "party_number", "country", "address1", "address2", "address3",
         "address4", "postal_code", "state", "creation_date", "email_address"],
    )
    hl = prefixed(relations("hz_locations"), "hl", ["location_id", "city", "province"])
    profiles = prefixed(
        relations("hz_customer_profiles"), "hcp",
        ["cust_account_id", "credit_checking", "credit_hold", "collector_id", "profile_class_id",
         "autocash_hierarchy_id", "autocash_hierarchy_id_for_adr"],
    )
    # Accounts are joined first, all by one key but for the party, then the sites with their places;
    # the uses, of which there are most, come last and are moved once.
    accounts = (
        ac.join(hca, F.col("hca_cust_account_id") == F.col("ac_customer_id"))
        .join(profiles, F.col("hcp_cust_account_id") == F.col("hca_cust_account_id"))
        .join(hp, F.col("hca_party_id") == F.col("hp_party_id"))
    )
    places = hps.join(hl, F.col("hps_location_id") == F.col("hl_location_id"))
    sites = hcas.join(places, F.col("hcas_party_site_id") == F.col("hps_party_site_id"))
    return (
        accounts.join(sites, F.col("ac_customer_id") == F.col("hcas_cust_account_id"))
        .join(hcsu, F.col("hcas_cust_acct_site_id") == F.col("hcsu_cust_acct_site_id"))
    )


def _described(
    relation: DataFrame, key: str, joined_to: str, on_repeat: str | None = None, **columns: str
) -> DataFrame:
    """Description columns of a relation by the site column they are joined to.

    With ``on_repeat`` a key must have one description, see :func:`lookups.single_row`.
    """
    rows = relation.select(
        F.col(key).alias(joined_to), *[F.col(old).alias(new) for new, old in columns.items()]
    )
    return rows if on_repeat is None else lookups.single_row(rows, [joined_to], list(columns), on_repeat)


def _site_lookups(sites: DataFrame, relations: Relations, wanted: set[str]) -> DataFrame:
    """The one-row look-ups that give a wanted column.

    Literal filters sit on the outer side, before the join.
    """
    account_site = ["ac_customer_id", "hcas_cust_acct_site_id"]
    account_use = ["ac_customer_id", "hcsu_site_use_id"]
    available = (
        (
            {"siteUse"},
            "hcsu_site_use_code",
            lambda: _described(
                relations("ar_lookups").filter(F.col("lookup_type") == "SITE_USE_CODE"),
                "lookup_code", "hcsu_site_use_code", siteUseMeaning="meaning",
            ),
        ),
        (
            {"priceList"},
            "hcsu_price_list_id",
            lambda: _described(
                relations("oe_price_lists_active_v"),
                "price_list_id", "hcsu_price_list_id", priceList="price_list",
            ),
        ),
        (
            {"orderType"},
            "hcsu_order_type_id",
            lambda: _described(
                relations("oe_transaction_types_tl"),
                "transaction_type_id", "hcsu_order_type_id", orderType="name",
            ),
        ),
        (
            {"defaultSalesPerson", "salesPerson"},
            "hcsu_primary_salesrep_id",
            lambda: _described(
                relations("ra_salesreps_all"),
                "salesrep_id", "hcsu_primary_salesrep_id",
                defaultSalesPerson="name", resourceId="resource_id",
            ),
        ),
        (
            {"salesPerson"},
            "resourceId",
            lambda: _described(
                relations("jtf_rs_defresources_v"),
                "resource_id", "resourceId", on_repeat="raise", salesPerson="resource_name",
            ),
        ),
        (
            {"creditTerms", "termsDescription"},
            "hcsu_payment_term_id",
            lambda: _described(
                relations("ra_terms_tl").filter(F.col("language") == "US"),
                "term_id", "hcsu_payment_term_id",
                on_repeat="raise", creditTerms="name", termsDescription="description",
            ),
        ),
        (
            {"collector"},
            "hcp_collector_id",
            lambda: _described(
                relations("ar_collectors"), "collector_id", "hcp_collector_id",
                on_repeat="raise", collector="name",
            ),
        ),
        (
            {"profileClass"},
            "hcp_profile_class_id",
            lambda: _described(
                relations("hz_cust_profile_classes"),
                "profile_class_id", "hcp_profile_class_id", on_repeat="raise", profileClass="name",
            ),
        ),
        (set(lookups.CREDIT_LIMITS.values()), account_use, lambda: _site_credit_limits(relations)),
    )
    for gives, key, table in available:
        if gives & wanted:
            sites = lookups.look_up(sites, table(), key)
    named = [c for c in SITE_DETAILS if c in wanted]
    if not named:
        return sites
    # They hold only where the site's party is the account's own.
    own = F.col("hps_party_id") == F.col("hca_party_id")
    detailed = lookups.look_up(sites, site_details(relations, wanted), account_site)
    return detailed.withColumns({c: F.when(own, F.col(c)) for c in named})


def _site_credit_limits(relations: Relations) -> DataFrame:
    amounts = (
        relations("hz_cust_profile_amts")
        .filter(F.col("site_use_id").isNotNull())
        .select(
            F.col("cust_account_id").alias("ac_customer_id"),
            F.col("site_use_id").alias("hcsu_site_use_id"),
            F.col("currency_code").alias("currencyCode"),
            F.col("overall_credit_limit").alias("creditLimit"),
        )
    )
    return lookups.single_credit_limits(amounts, ["ac_customer_id", "hcsu_site_use_id"])


# Columns that are looked up by account site, by what they are taken from.
_BANK = ("bankName", "bankAccountNumber", "bankBranchName")
_PHONE, _MAIL = ("phone",), ("contactEmail",)
_PERSON = ("contactPerson", "jobTitle")
SITE_DETAILS = (*_BANK, *_PHONE, *_MAIL, *_PERSON)
_ACCOUNT_SITE = ("ac_customer_id", "hcas_cust_acct_site_id")


def site_details(relations: Relations, wanted: set[str]) -> DataFrame:
    """What is looked up by account site, all of it in one shuffle and one aggregate.

    Candidates of all kinds are put below each other with their rank, and each kind's first by
    rank is picked, so its columns stay together. Kinds that give no wanted column are left out.
    """
    kinds, parts = [], []
    if wanted & set(_BANK):
        kinds.append(("bank", _BANK))
        parts.append(_bank_candidates(relations))
    if wanted & {*_PHONE, *_MAIL, *_PERSON}:
        people = bool(wanted & set(_PERSON))
        kinds += [("phone", _PHONE), ("mail", _MAIL), *([("person", _PERSON)] if people else [])]
        parts.append(_contact_candidates(relations, people))
    candidates = reduce(DataFrame.unionByName, parts)
    first = {
        kind: F.min_by(F.struct("v1", "v2", "v3"), F.when(F.col("kind") == kind, F.struct("n1", "n2", "v1", "v3")))
        for kind, _ in kinds
    }
    found = candidates.groupBy(*_ACCOUNT_SITE).agg(*[pick.alias(kind) for kind, pick in first.items()])
    return found.select(
        *_ACCOUNT_SITE, *[F.col(f"{kind}.v{k}").alias(c) for kind, columns in kinds for k, c in enumerate(columns, 1)]
    )


def _candidate(kind: str, rank: tuple[str, str | None], values: tuple[str, ...]) -> list[Column]:
    """Columns of a candidate: the rank is two numbers, then the values themselves."""
    n1, n2 = rank
    texts = [F.col(v).cast("string") for v in values] + [F.lit(None).cast("string")] * (3 - len(values))
    return [
        F.lit(kind).alias("kind"), F.col(n1).cast("bigint").alias("n1"),
        (F.lit(0) if n2 is None else F.col(n2)).cast("bigint").alias("n2"),
        *[t.alias(f"v{k}") for k, t in enumerate(texts, 1)],
    ]


def _bank_candidates(relations: Relations) -> DataFrame:
    """Bank, account number and branch of a customer's account sites; the first account ranks first.

    An account is held by one site use; it counts for all uses of that account site.
    All three come from one joined relation, so they describe the same account.
    """
    organizations = relations("hz_organization_profiles").select("party_id").distinct()
    parties = relations("hz_parties").select("party_id", "party_type", "party_name").join(
        organizations, "party_id", "left_semi"
    )
    branch_of = (
        relations("hz_relationships")
        .filter(
            (F.col("relationship_code") == "BRANCH_OF")
            & (F.col("object_table_name") == "HZ_PARTIES")
            & (F.col("subject_table_name") == "HZ_PARTIES")
        )
        .select(
            F.col("object_id").alias("bank_id"),
            F.col("object_type").alias("bankType"),
            F.col("subject_id").alias("branch_id"),
            F.col("subject_type").alias("branchType"),
        )
    )
    bank = parties.select(
        F.col("party_id").alias("bank_id"), F.col("party_type").alias("bankType"), F.col("party_name").alias("bankName")
    )
    branch = parties.select(
        F.col("party_id").alias("branch_id"), F.col("party_type").alias("branchType"),
        F.col("party_name").alias("bankBranchName"),
    )
    uses = relations("iby_pmt_instr_uses_all").select(
        F.col("instrument_id").alias("ext_bank_account_id"),
        F.col("ext_pmt_party_id").alias("ext_payer_id"),
    )
    payers = relations("iby_external_payers_all").select(
        "ext_payer_id",
        F.col("cust_account_id").alias("ac_customer_id"),
        F.col("acct_site_use_id").alias("site_use_id"),
    )
    site_uses = relations("hz_cust_site_uses_all").select(
        "site_use_id", F.col("cust_acct_site_id").alias("hcas_cust_acct_site_id")
    )
    accounts = relations("iby_ext_bank_accounts").select(
        "ext_bank_account_id", "bank_id", "branch_id",
        F.col("bank_account_num").alias("bankAccountNumber"),
    )
    # Banks and branches are few and joined first; the accounts then move once for them.
    named = branch_of.join(bank, ["bank_id", "bankType"]).join(branch, ["branch_id", "branchType"])
    joined = (
        accounts.join(named, ["bank_id", "branch_id"])
        .join(uses, "ext_bank_account_id")
        .join(payers, "ext_payer_id")
        .join(site_uses, "site_use_id")
    )
    return joined.select(*_ACCOUNT_SITE, *_candidate("bank", ("ext_bank_account_id", None), _BANK))


def _registered_contacts(relations: Relations) -> DataFrame:
    """Per organization party and registered contact, whether its relationship has an active owner."""
    contacts = relations("hz_org_contacts").select(
        F.col("party_relationship_id").alias("relationship_id"), "org_contact_id"
    )
    related = relations("hz_relationships").select(
        "relationship_id",
        F.col("object_id").alias("orgPartyId"),
        F.col("subject_id").alias("personPartyId"),
        F.col("party_id").alias("relationshipPartyId"),
    )
    people = relations("hz_parties").select(F.col("party_id").alias("personPartyId"))
    active = (
        relations("hz_contact_points").filter(F.col("status") == "A")
        .select(F.col("owner_table_id").alias("relationshipPartyId"), F.lit(True).alias("active")).distinct()
    )
    registered = related.join(contacts, "relationship_id").join(people, "personPartyId", "left_semi")
    return registered.join(active, "relationshipPartyId", "left").groupBy("orgPartyId", "org_contact_id").agg(
        F.coalesce(F.max("active"), F.lit(False)).alias("active")
    )


def _contact_candidates(relations: Relations, with_people: bool) -> DataFrame:
    """Phone numbers, e-mail addresses and, if wanted, people of account sites.

    Numbers and addresses count where the account's party is an organization with a registered
    contact, people where they are a registered contact whose relationship has an active owner.
    """
    accounts = relations("hz_cust_accounts").select("cust_account_id", F.col("party_id").alias("orgPartyId"))
    roles = relations("hz_cust_account_roles").select(
        "cust_account_id", "cust_acct_site_id", F.col("party_id").alias("rolePartyId")
    )
    points = relations("hz_contact_points").select(
        F.col("owner_table_id").alias("rolePartyId"),
        "contact_point_id",
        "contact_point_type",
        codes.join_text(
            "-", F.col("phone_country_code"), F.col("phone_area_code"), F.col("phone_number")
        ).alias("phone"),
        F.col("email_address").alias("contactEmail"),
    )
    registered = written(_registered_contacts(relations), "registered")
    organizations = relations("hz_parties").filter(F.col("party_type") == "ORGANIZATION").select(
        F.col("party_id").alias("orgPartyId")
    ).join(registered.select("orgPartyId"), "orgPartyId", "left_semi").distinct()
    rows = (
        roles.join(accounts, "cust_account_id")
        .join(organizations.withColumn("registered", F.lit(True)), "orgPartyId", "left")
        .join(points, "rolePartyId")
        .select(
            F.col("cust_account_id").alias("ac_customer_id"), F.col("cust_acct_site_id").alias("hcas_cust_acct_site_id"),
            "orgPartyId", "registered", "contact_point_id", "contact_point_type", "phone", "contactEmail",
        )
    )
    is_kind = lambda kind: F.col("registered") & (F.col("contact_point_type") == kind)
    point = ("contact_point_id", None)
    shaped = [
        F.when(is_kind("PHONE"), F.struct(*_candidate("phone", point, _PHONE))),
        F.when(is_kind("EMAIL"), F.struct(*_candidate("mail", point, _MAIL))),
    ]
    if with_people:
        people = relations("ar_contacts_v").select(
            "contact_point_id",
            "org_contact_id",
            codes.join_text(" ", F.col("first_name"), F.col("last_name")).alias("contactPerson"),
            F.col("job_title").alias("jobTitle"),
        ).join(registered.where("active").drop("active"), "org_contact_id")
        rows = rows.join(people, ["contact_point_id", "orgPartyId"], "left")
        person = F.struct(*_candidate("person", ("contact_point_id", "org_contact_id"), _PERSON))
        shaped.append(F.when(F.col("org_contact_id").isNotNull(), person))
    return rows.select(*_ACCOUNT_SITE, F.explode(F.array_compact(F.array(*shaped))).alias("c")).select(*_ACCOUNT_SITE, "c.*")


def _extract_columns() -> dict[str, Column]:
    """Output columns of the extract that are not plain look-up columns."""
    number = keys.number_text(F.col("ac_customer_number"))
    return {
        "customerNumber": number,
        "customerKey": keys.party_key(F.col("hcsu_location"), number),
        "creationDate": dates.day_month_year(F.col("hp_creation_date")),
        "accountType": codes.decode(F.col("hca_customer_type"), codes.ACCOUNT_TYPES),
        "siteUseId": keys.number_text(F.col("hcsu_site_use_id")),
        "siteUse": codes.byte_prefix(F.col("siteUseMeaning"), 8),
        "creditCheck": codes.decode(F.col("hcp_credit_checking"), codes.YES_NO),
    } | {new: F.col(old) for new, old in _PASSED.items()}


# Extract columns that are passed on as they are.
_PASSED = {
    "customerClass": "ac_customer_class_code",
    "status": "ac_status",
    "customerType": "hp_party_type",
    "name": "ac_customer_name",
    "siteName": "hps_party_site_name",
    "siteNumber": "hps_party_site_number",
    "custAccountId": "hcas_cust_account_id",
    "siteStatus": "hcsu_status",
    "location": "hcsu_location",
    "country": "hp_country",
    "address1": "hp_address1",
    "address2": "hp_address2",
    "address3": "hp_address3",
    "address4": "hp_address4",
    "partyNumber": "hp_party_number",
    "city": "hl_city",
    "locationId": "hl_location_id",
    "postalCode": "hp_postal_code",
    "state": "hp_state",
    "territory": "hl_province",
    "subDistCreditPercent": "hca_attribute10",
    "selfCollectRebate": "hca_attribute3",
    "transportRebate": "hps_attribute1",
    "teamLeader": "hcsu_attribute1",
    "tradeType": "hcsu_attribute2",
    "salesTerritory": "hca_attribute2",
    "priceListId": "hcsu_price_list_id",
    "orderTypeId": "hcsu_order_type_id",
    "creditHold": "hcp_credit_hold",
    "autocashHierarchyId": "hcp_autocash_hierarchy_id",
    "autocashHierarchyIdForAdr": "hcp_autocash_hierarchy_id_for_adr",
    "freightTerms": "hcsu_freight_term",
    "taxpayerId": "ac_taxpayer_id",
    "taxRegistrationNumber": "ac_tax_reference",
    "companyRegisterId": "ac_attribute4",
    "partyId": "hp_party_id",
    "email": "hp_email_address",
}
_LOOKED_UP = (
    "priceList", "orderType", "defaultSalesPerson", "salesPerson", "creditTerms",
    "termsDescription", "collector", "profileClass", "kesCreditLimit", "usdCreditLimit",
    "gbpCreditLimit", "bankName", "bankAccountNumber", "bankBranchName", "phone",
    "contactEmail", "contactPerson", "jobTitle",
)


def customer_rows(
    relations: Relations,
    customer_numbers: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the customer site extract; fewer ``columns`` mean fewer joins."""
    made = _extract_columns()
    names = list(columns) if columns is not None else [*made, *_LOOKED_UP]
    sites = _site_lookups(customer_sites(relations, customer_numbers), relations, set(names))
    return sites.select(*[made.get(n, F.col(n)).alias(n) for n in names])


def customer_extract(
    relations: Relations,
    customer_numbers: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The customer site extract, distinct rows."""
    return customer_rows(relations, customer_numbers, columns).distinct()


def customer_master(
    relations: Relations, customer_numbers: DataFrame | None = None
) -> DataFrame:
    """The eight canonical columns, one row per customer key.

    The first row of a key is that of its lowest site use id. No distinct comes
    first: repeats do not change a minimum.
    """
    firsts = [c for c in CUSTOMER_COLUMNS if c != "customerKey"]
    rows = customer_rows(relations, customer_numbers, [*CUSTOMER_COLUMNS, "siteUseId"])
    ranked = rows.withColumn("siteUseId", F.col("siteUseId").try_cast("bigint"))
    return one_row_per_party(ranked, "customerKey", firsts, ["siteUseId"])
