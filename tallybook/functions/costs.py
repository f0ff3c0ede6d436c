"""Cost arithmetic in exact decimals. Doubles appear only where a report leaves the library."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.schemas import MONEY, RATE

BASE_CURRENCY = "USD"
COMMITTED = "COMMITTED_USAGE_DISCOUNT"

# Charge class per AWS line-item type and per GCP cost type.
AWS_CHARGE_CLASS = {
    "Usage": "usage",
    "DiscountedUsage": "covered_usage",
    "SavingsPlanCoveredUsage": "covered_usage",
    "RIFee": "fee",
    "Tax": "tax",
    "Credit": "credit",
}
GCP_CHARGE_CLASS = {
    "regular": "usage",
    "tax": "tax",
    "adjustment": "adjustment",
    "rounding_error": "adjustment",
}
COMMITMENT_SKU_PREFIX = "Commitment "


def money(column: Column) -> Column:
    return column.cast(MONEY)


def tag(labels: Column, key: str) -> Column:
    """Value of the first label named ``key``; null when there is none."""
    return F.get(F.filter(labels, lambda label: label["key"] == key), F.lit(0))["value"]


def credit_total(credits: Column) -> Column:
    """Sum of the credit amounts of one row. Null and empty arrays both give zero."""
    zero = F.lit(0).cast(MONEY)
    return F.coalesce(
        F.aggregate(
            credits,
            zero,
            lambda total, credit: money(total + F.coalesce(credit["amount"], zero)),
        ),
        zero,
    )


def net_cost(cost: Column, credits: Column) -> Column:
    return money(cost + credit_total(credits))


def to_base(amount: Column, rate: Column) -> Column:
    """Unrounded product in the base currency; round once, after summing."""
    return amount * rate.cast(RATE)


def has_credit(credits: Column, kind: str) -> Column:
    return F.exists(credits, lambda credit: credit["type"] == kind)


def aws_effective_cost(line_type: Column, unblended: Column, effective: Column) -> Column:
    """What the usage really cost: the reservation share for covered rows, else the billed cost."""
    return F.when(line_type == "DiscountedUsage", effective).otherwise(unblended)


def amortised_cost(charge: Column, effective: Column) -> Column:
    """Effective cost without commitment fees, whose amount the covered rows already carry."""
    return F.when(charge == "fee", F.lit(0).cast(MONEY)).otherwise(effective)


def _lookup(column: Column, values: dict[str, str], unknown: str) -> Column:
    result = F
    for key, value in values.items():
        result = result.when(column == key, value)
    return result.otherwise(unknown)


def charge_class(provider: Column, kind: Column, text: Column) -> Column:
    """Usage, covered usage, fee, tax, credit, adjustment or other.

    A GCP commitment fee is only told apart from usage by its SKU text.
    """
    gcp = F.when(
        (kind == "regular") & F.coalesce(text.startswith(COMMITMENT_SKU_PREFIX), F.lit(False)), "fee"
    ).otherwise(_lookup(kind, GCP_CHARGE_CLASS, "other"))
    return (
        F.when(provider == "AWS", _lookup(kind, AWS_CHARGE_CLASS, "other"))
        .when(provider == "GCP", gcp)
        .otherwise("other")
    )


def not_in_base(currency: Column) -> Column:
    """True for rows of a foreign or missing currency."""
    return ~currency.eqNullSafe(BASE_CURRENCY)


def pricing_usage(usage: Column) -> tuple[Column, Column]:
    """Amount and unit the price refers to, rather than the raw measure."""
    return usage["amount_in_pricing_units"], usage["pricing_unit"]
