"""Party and invoice keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(text: Column) -> Column:
    """Lower-case text with everything but ``a-z0-9`` removed; null becomes ''.

    Blanks are outside the kept set, so no separate trim is needed.
    """
    return F.coalesce(F.regexp_replace(F.lower(text), "[^a-z0-9]", ""), F.lit(""))


def number_text(number: Column) -> Column:
    """A party number as text, spelled the same from text, whole and float sources."""
    return F.regexp_replace(F.trim(number.cast("string")), r"\.0+$", "")


def party_key(site: Column, number: Column) -> Column:
    """``normalized-site_number``; a null number is spelled ``None``."""
    return F.concat(
        normalize_text(site), F.lit("_"), F.coalesce(number.cast("string"), F.lit("None"))
    )


def invoice_key(vendor_id: Column, invoice_number: Column) -> Column:
    """``vendor_invoice``; null when either part is null."""
    return F.concat(vendor_id.cast("string"), F.lit("_"), invoice_number.cast("string"))
