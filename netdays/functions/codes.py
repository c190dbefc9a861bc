"""Code values to display text, and null-tolerant text assembly."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display text of the ERP's codes.
ACCOUNT_TYPES = {"R": "External", "I": "Internal"}
YES_NO = {"Y": "Yes", "N": "No"}
MATCHING_LEVELS = ("2-Way", "3-Way", "4-Way")


def decode(code: Column, texts: Mapping[str, str]) -> Column:
    """Display text of a code; an unknown code, or null, is passed through."""
    out = None
    for key, text in texts.items():
        out = F.when(code == key, text) if out is None else out.when(code == key, text)
    return code if out is None else out.otherwise(code)


def matching_level(receipt_required: Column, inspection_required: Column) -> Column:
    """How many documents must agree; inspection counts only with a receipt."""
    two_way, three_way, four_way = MATCHING_LEVELS
    receipt = F.coalesce(receipt_required, F.lit("N")) == "Y"
    inspection = F.coalesce(inspection_required, F.lit("N")) == "Y"
    return (
        F.when(receipt & inspection, four_way).when(receipt, three_way).otherwise(two_way)
    )


def join_text(separator: str, *parts: Column) -> Column:
    """Parts joined by a separator, null parts as '' with their separator kept."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(part.cast("string"), F.lit("")))
    return F.concat(*pieces)


def byte_prefix(text: Column, size: int) -> Column:
    """The first ``size`` UTF-8 bytes, less a character cut in the middle."""
    raw = F.encode(text, "UTF-8")
    shorter = [F.substring(raw, 1, size - cut).cast("string") for cut in range(min(4, size))]
    return F.coalesce(*[F.try_validate_utf8(s) for s in shorter])
