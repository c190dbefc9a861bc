"""Run parameters for both sides, checked when they are made."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

# Digits that a rate and a percentage may have, so that products fit 38 digits.
MAX_RATE_DIGITS = 17
MAX_PERCENT_DIGITS = 8


def _decimal(value: Any) -> Decimal:
    return value if isinstance(value, Decimal) else Decimal(str(value))


def _digits(number: Decimal) -> int:
    """Digits of a number in plain notation."""
    _, digits, exponent = number.normalize().as_tuple()
    return len(digits) + exponent if exponent > 0 else max(len(digits), -exponent)


def _percent(name: str, value: Any) -> Decimal:
    number = _decimal(value)
    if number < 0:
        raise ValueError(f"{name} must not be negative: {number}")
    if _digits(number) > MAX_PERCENT_DIGITS:
        raise ValueError(f"{name} has more than {MAX_PERCENT_DIGITS} digits: {number}")
    return number


def _days(name: str, value: Any) -> int:
    days = int(value)
    if not 0 <= days < 2**31:
        raise ValueError(f"{name} must be a number of days: {days}")
    return days


def _tier_entries(request: Mapping[Any, Any]) -> dict[int, Any]:
    """Entries keyed ``14`` or ``"d_14"``."""
    out = {}
    for key, value in request.items():
        if isinstance(key, int):
            out[key] = value
        elif isinstance(key, str) and key.startswith("d_") and key[2:].isdigit():
            out[int(key[2:])] = value
    return out


@dataclass(frozen=True)
class CustomerParams:
    """Receivables: percentages are percents, tiers map term days to days saved."""

    exchange_rate: Decimal
    cost_of_finance_per_day: Decimal
    max_discount: Decimal
    share_of_savings: Decimal
    tiers: Mapping[int, int] = field(default_factory=dict)
    minimum_amount: Decimal | None = None

    def __post_init__(self) -> None:
        rate = _decimal(self.exchange_rate)
        if rate <= 0 or _digits(rate) > MAX_RATE_DIGITS:
            raise ValueError(f"exchange rate must be positive and have at most {MAX_RATE_DIGITS} digits: {rate}")
        put = object.__setattr__
        put(self, "exchange_rate", rate)
        put(self, "cost_of_finance_per_day", _percent("cost of finance", self.cost_of_finance_per_day))
        put(self, "max_discount", _percent("largest discount", self.max_discount))
        put(self, "share_of_savings", _percent("share of savings", self.share_of_savings))
        put(self, "tiers", {int(k): _days(f"tier {k}", v) for k, v in self.tiers.items()})
        if self.minimum_amount is not None:
            put(self, "minimum_amount", _decimal(self.minimum_amount))

    @classmethod
    def from_request(cls, request: Mapping[Any, Any]) -> CustomerParams:
        """Accepts the field names of the offer request."""
        return cls(
            exchange_rate=request["exchange_rate"],
            cost_of_finance_per_day=request["cost_of_finance_per_day"],
            max_discount=request["max_discount_amount"],
            share_of_savings=request["persentage_of_discount_savings"],
            tiers=_tier_entries(request),
            minimum_amount=request.get("minimum_threshold"),
        )


@dataclass(frozen=True)
class SupplierTier:
    early_days: int
    percent: Decimal

    def __post_init__(self) -> None:
        object.__setattr__(self, "early_days", _days("early days", self.early_days))
        percent = _percent("discount", self.percent)
        if -percent.normalize().as_tuple().exponent > 4:
            raise ValueError(f"a tier discount has at most 4 decimal places: {percent}")
        object.__setattr__(self, "percent", percent)


@dataclass(frozen=True)
class SupplierParams:
    """Payables: tiers map term days to (days paid early, discount percent)."""

    tiers: Mapping[int, SupplierTier] = field(default_factory=dict)

    def __post_init__(self) -> None:
        made = {
            int(k): v if isinstance(v, SupplierTier) else SupplierTier(*v)
            for k, v in self.tiers.items()
        }
        object.__setattr__(self, "tiers", made)

    @classmethod
    def from_request(cls, request: Mapping[Any, Any]) -> SupplierParams:
        return cls(tiers=_tier_entries(request))


# The sample parameters of both sides.
SAMPLE_CUSTOMER = CustomerParams(
    exchange_rate=Decimal("160"),
    cost_of_finance_per_day=Decimal("0.2"),
    max_discount=Decimal("9"),
    share_of_savings=Decimal("40"),
    tiers={14: 7, 21: 11, 30: 15, 45: 21, 60: 30},
)
CAPPED_CUSTOMER = CustomerParams(
    exchange_rate=Decimal("160"),
    cost_of_finance_per_day=Decimal("0.2"),
    max_discount=Decimal("2"),
    share_of_savings=Decimal("40"),
    tiers={14: 7, 21: 11, 30: 15, 45: 21, 60: 30},
)
SAMPLE_SUPPLIER = SupplierParams(
    tiers={
        14: (7, "0.7"),
        15: (7, "0.7"),
        20: (10, "1"),
        30: (15, "1.5"),
        45: (25, "2.5"),
        60: (30, "3"),
        90: (40, "4"),
        365: (65, "6.5"),
    }
)
