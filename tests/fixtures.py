"""Small feeds of our own invention in the two vendor shapes; their totals are worked out by hand in the tests."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tallybook import schemas

ARN = "arn:aws:ec2:eu-north-1:77:reserved-instances/ri-orchid"
DAY = "2031-03-05"
MONTH = ("2031-03-01T00:00:00Z", "2031-04-01T00:00:00Z")


def hour(n: int) -> tuple[str, str]:
    return f"{DAY}T{n:02d}:00:00Z", f"{DAY}T{n + 1:02d}:00:00Z"


def _line(name: str, kind: str, cost: str, span: tuple[str, str], **fields) -> tuple:
    row = {
        "line_item_id": name, "time_interval": f"{span[0]}/{span[1]}", "payer_account_id": "70", "usage_account_id": "77",
        "line_item_type": kind, "usage_start": span[0], "usage_end": span[1], "product_code": "Compute", "usage_type": kind,
        "usage_amount": Decimal(0), "unblended_cost": Decimal(cost), **fields,
    }
    return tuple(row.get(column) for column in schemas.LINE_ITEM.fieldNames())


def _run(name: str, kind: str, cost: str, at: int, machine: str, team: str, list_price: str, **fields) -> tuple:
    terms = {"DiscountedUsage": "Reserved", "Usage": "OnDemand", "SavingsPlanCoveredUsage": "SavingsPlan"}
    return _line(
        name, kind, cost, hour(at), usage_type=f"BoxUsage:{machine}", operation="Run", resource_id=f"vm-{name}",
        usage_amount=Decimal(1), instance_type=machine, region="eu-north-1", pricing_term=terms[kind],
        on_demand_cost=Decimal(list_price), tag_team=team, tag_cost_center=f"{team}-7", **fields,
    )


def line_items(spark: SparkSession) -> DataFrame:
    """Thirteen line items: three reserved hours of a fee of 120, free use, a plan, storage, taxes and a credit."""
    reserved = {"reservation_effective_cost": Decimal("0.30"), "reservation_arn": ARN}
    rows = [
        _line("fee", "RIFee", "36.00", MONTH, usage_amount=Decimal(120), reservation_arn=ARN, instance_type="m6.large"),
        *(_run(f"res-{n}", "DiscountedUsage", "0", n, "m6.large", "orchid", "0.50", **reserved) for n in (1, 2, 3)),
        *(_run(f"use-{n}", "Usage", "1.25", n, "c7.xlarge", "maple", "1.25") for n in (4, 5)),
        _run("use-6", "Usage", "2.75", 6, "c7.2xlarge", "cedar", "2.75"),
        *(_run(f"plan-{n}", "SavingsPlanCoveredUsage", "0.333333", n, "m6.large", "cedar", "0.50") for n in (7, 8)),
        _line(
            "disk", "Usage", "0.055555", hour(9), product_code="Disks", usage_type="Volume", usage_amount=Decimal("81.25"),
            on_demand_cost=Decimal("0.055555"), tag_team="maple",
        ),
        _line("tax-1", "Tax", "3.10", MONTH),
        _line("tax-2", "Tax", "0.90", MONTH),
        _line("refund", "Credit", "-7.77", MONTH),
    ]
    return spark.createDataFrame(rows, schemas.LINE_ITEM)


def billing_rows(spark: SparkSession) -> DataFrame:
    """Nine billing rows of three teams; one in another currency, one commitment fee, one of two credits."""
    core = (Decimal(3600), "seconds", Decimal(1), "hour")

    def row(team, sku, span, cost, usage, credits=(), currency="USD", rate="1"):
        return (
            "acct-7", ("svc", "Cloud"), sku, span[0], span[1], (f"proj-{team}", team), [("team", team), ("floor", "3")],
            Decimal(cost), currency, Decimal(rate), usage, [(n, Decimal(a), k) for n, a, k in credits], "regular",
        )

    e9 = ("sku-e9", "E9 Instance Core running in Europe")
    n7 = ("sku-n7", "N7 Instance Core running in Europe")
    free = ("Free", "-0.80", "FREE_TIER")
    two = [("Steady", "-0.45", "SUSTAINED_USAGE_DISCOUNT"), ("Free", "-0.05", "FREE_TIER")]
    rows = [
        row("cedar", ("sku-box", "Object boxes"), hour(1), "4.00", (Decimal(9), "boxes", Decimal(9), "box"), (), "GBP", "1.25"),
        row("cedar", n7, hour(2), "5.00", core, two),
        *(row("maple", e9, hour(n), "3.10", core) for n in (3, 4)),
        *(row("orchid", e9, hour(n), "2.00", core, [("Pledge", "-0.70", "COMMITTED_USAGE_DISCOUNT")]) for n in (1, 2, 3)),
        row("orchid", ("sku-scan", "Scanned bytes"), hour(1), "0.80", (Decimal(2**41), "bytes", Decimal(2), "tebibyte"), [free]),
        row(
            "maple", ("sku-pledge", "Commitment v1: E9 Cpu in Europe for 3 Years"), MONTH, "90.00",
            (Decimal(0), "seconds", Decimal(0), "hour"),
        ),
    ]
    return spark.createDataFrame(rows, schemas.BILLING_ROW)
