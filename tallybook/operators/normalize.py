"""Both vendors' rows in one canonical cost table, and spend rolled up from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.functions import costs, text

CANONICAL = [
    "provider", "line_id", "account", "service", "sku", "machine", "team", "cost_center",
    "charge_class", "usage_start", "usage_end", "usage_amount", "usage_unit", "currency", "rate",
    "list_cost", "net_cost", "effective_cost",
]


def usage_window(df: DataFrame, interval: str = "time_interval") -> DataFrame:
    """Add the bounds of a ``start/end`` string and the whole seconds between them."""
    start, end = text.interval_bounds(F.col(interval))
    return df.withColumns({"window_start": start, "window_end": end}).withColumn(
        "window_seconds", F.timestamp_diff("SECOND", F.col("window_start"), F.col("window_end"))
    )


def canonical_aws(items: DataFrame) -> DataFrame:
    c = F.col
    effective = costs.aws_effective_cost(
        c("line_item_type"), c("unblended_cost"), c("reservation_effective_cost")
    )
    return items.select(
        F.lit("AWS").alias("provider"),
        c("line_item_id").alias("line_id"),
        c("usage_account_id").alias("account"),
        c("product_code").alias("service"),
        c("usage_type").alias("sku"),
        F.coalesce(c("instance_type"), text.instance_type(c("usage_type"))).alias("machine"),
        c("tag_team").alias("team"),
        c("tag_cost_center").alias("cost_center"),
        costs.charge_class(F.lit("AWS"), c("line_item_type"), c("usage_type")).alias("charge_class"),
        F.try_to_timestamp("usage_start").alias("usage_start"),
        F.try_to_timestamp("usage_end").alias("usage_end"),
        c("usage_amount").cast(schemas.QUANTITY).alias("usage_amount"),
        F.lit(None).cast("string").alias("usage_unit"),
        F.lit(costs.BASE_CURRENCY).alias("currency"),
        F.lit(1).cast(schemas.RATE).alias("rate"),
        costs.money(c("on_demand_cost")).alias("list_cost"),
        costs.money(c("unblended_cost")).alias("net_cost"),
        costs.money(effective).alias("effective_cost"),
    )


def canonical_gcp(rows: DataFrame) -> DataFrame:
    c = F.col
    amount, unit = costs.pricing_usage(c("usage"))
    net = costs.net_cost(c("cost"), c("credits"))
    return rows.select(
        F.lit("GCP").alias("provider"),
        gcp_line_id().alias("line_id"),
        c("project.id").alias("account"),
        c("service.description").alias("service"),
        c("sku.description").alias("sku"),
        text.machine_family(c("sku.description")).alias("machine"),
        costs.tag(c("labels"), "team").alias("team"),
        costs.tag(c("labels"), "cost_center").alias("cost_center"),
        costs.charge_class(F.lit("GCP"), c("cost_type"), c("sku.description")).alias("charge_class"),
        F.try_to_timestamp("usage_start_time").alias("usage_start"),
        F.try_to_timestamp("usage_end_time").alias("usage_end"),
        amount.cast(schemas.QUANTITY).alias("usage_amount"),
        unit.alias("usage_unit"),
        c("currency"),
        c("currency_conversion_rate").cast(schemas.RATE).alias("rate"),
        c("cost").alias("list_cost"),
        net.alias("net_cost"),
        net.alias("effective_cost"),
    )


def gcp_line_id() -> Column:
    """Billing rows carry no id: project, SKU and start of usage identify one."""
    return text.content_id(F.col("project.id"), F.col("sku.id"), F.col("usage_start_time"))


def canonical(items: DataFrame, rows: DataFrame) -> DataFrame:
    return canonical_aws(items).unionByName(canonical_gcp(rows))


def with_provider_name(df: DataFrame) -> DataFrame:
    """Add the provider's display name; the dimension is two literal rows."""
    values = ", ".join(f"('{code}', '{name}')" for code, name in schemas.PROVIDERS.items())
    names = df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(provider, provider_name)")
    return df.join(F.broadcast(names), "provider", "left")


def in_base(column: str) -> Column:
    """Sum of a canonical cost column in the base currency, rounded once."""
    return F.round(F.sum(costs.to_base(F.col(column), F.col("rate"))), 6)


def spend_by(df: DataFrame, keys: Sequence[str], grain: str | None = None) -> DataFrame:
    """Row count and base-currency totals of canonical rows per ``keys`` and, if given, time grain."""
    names = list(keys)
    if grain:
        df = df.withColumn(grain, F.date_trunc(grain, "usage_start"))
        names.append(grain)
    amounts = ["list_cost", "net_cost", "effective_cost"]
    return df.groupBy(*names).agg(
        F.count(F.lit(1)).alias("line_count"), *(in_base(a).alias(a) for a in amounts)
    )


def cost_views(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cash and amortised totals side by side. They describe the same spend: never add them."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("net_cost").alias("cash_cost"),
        F.sum(costs.amortised_cost(F.col("charge_class"), F.col("effective_cost"))).alias(
            "amortised_cost"
        ),
    )


def credit_types(rows: DataFrame) -> DataFrame:
    """Distinct credit types of billing rows, with the credits and amounts behind them."""
    return (
        rows.select(F.explode("credits").alias("credit"))
        .groupBy(F.col("credit.type").alias("credit_type"))
        .agg(F.count(F.lit(1)).alias("credits"), F.sum("credit.amount").alias("amount"))
    )


_SECONDS = {"hour": 3600, "day": 86400}
_MILLION = 1_000_000


def _largest_remainders(amount: Column, weights: Column, whole: Column) -> Column:
    """An amount's parts by weight, as decimals of six places that sum to it; ``weights`` sum to ``whole``."""
    units = (F.abs(amount) * _MILLION).cast("decimal(20,0)")

    def share(weight: Column, place: Column) -> Column:
        product = units * weight.cast("decimal(18,0)")
        rest = product % whole
        return F.struct((-rest).alias("rest"), place.alias("place"), ((product - rest) / whole).cast("bigint").alias("floor"))

    # ordered by what the floor takes from them, the most first; then by place
    shares = F.array_sort(F.transform(weights, share))
    lacking = units.cast("bigint") - F.aggregate(shares, F.lit(0).cast("bigint"), lambda total, x: total + x["floor"])

    def part(x: Column, order: Column) -> Column:
        units = (x["floor"] + F.when(order < lacking, 1).otherwise(0)) * F.signum(amount).cast("bigint")
        exact = units.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")
        return F.struct(x["place"].alias("place"), exact.cast(schemas.MONEY).alias("amount"))

    return F.transform(F.array_sort(F.transform(shares, part)), lambda x: x["amount"])


def apportioned(
    df: DataFrame, amounts: Sequence[str], grain: str, start: str = "usage_start", end: str = "usage_end"
) -> DataFrame:
    """Each row split over the hours or days (UTC) that it spans, with ``part_start`` and its part of each amount.

    Amounts go by seconds, and what rounding leaves goes to the largest remainders, the earlier of equals first: the
    parts sum to the whole in all six places. A row without a span is one part at its start; without a start, one
    part without a time. Amounts are decimals of six places, null ones stay null.
    """
    unit = _SECONDS[grain]
    c = F.col
    rows = df.withColumns({"_s": F.unix_seconds(start), "_e": F.unix_seconds(end)})
    first = c("_s") - F.pmod(c("_s"), F.lit(unit))
    spans = F.coalesce(c("_e") > c("_s"), F.lit(False))
    last = F.when(spans, c("_e") - 1 - F.pmod(c("_e") - 1, F.lit(unit))).otherwise(first)
    rows = rows.withColumn("_starts", F.sequence(first, last, F.lit(unit).cast("bigint")))
    weight = lambda t: F.least(c("_e"), t + unit) - F.greatest(c("_s"), t)
    rows = rows.withColumns({
        "_weights": F.when(spans, F.transform("_starts", weight)).otherwise(F.array(F.lit(1).cast("bigint"))),
        "_whole": F.when(spans, c("_e") - c("_s")).otherwise(1).cast("decimal(18,0)"),
    })
    parts = {f"_parts_{k}": _largest_remainders(c(n), c("_weights"), c("_whole")) for k, n in enumerate(amounts)}
    rows = rows.withColumns(parts)
    zipped = F.arrays_zip(c("_starts").alias("at"), *(c(f"_parts_{k}").alias(f"p{k}") for k in range(len(amounts))))
    rows = rows.withColumn("_part", F.explode_outer(zipped))
    place = {n: k for k, n in enumerate(amounts)}
    kept = [
        F.when(c("_part").isNull(), c(n).cast(schemas.MONEY)).otherwise(c(f"_part.p{place[n]}")).alias(n) if n in place else c(n)
        for n in df.columns
    ]
    return rows.select(*kept, F.timestamp_seconds("_part.at").alias("part_start"))
