"""Matching one set of rows with another: seen ids, coverage, reservations, round trips, arrivals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions import costs
from tallybook.functions.text import elapsed_millis, reservation_id
from tallybook.operators.ordering import (
    CHUNK,
    HOT_ROWS,
    PLACE,
    before,
    chunk_window,
    chunked,
    hot_keys,
    join_spans,
    span_summary,
    span_window,
    split_hot,
)


def drop_seen(df: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not among those already processed; all copies of a new key stay, and null keys.

    Left to adaptive execution, which splits the rows of a key that fills a task.
    """
    return df.join(seen.select(*on), list(on), "left_anti")


def lookup(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is among ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def _where(condition: Column, column: str) -> Column:
    return F.when(condition, F.col(column))


def coverage_by_sku(rows: DataFrame) -> DataFrame:
    """Per SKU, base-currency net cost per pricing unit of committed and of uncredited usage."""
    c = F.col
    committed = costs.has_credit(c("credits"), costs.COMMITTED)
    bare = F.size("credits") == 0
    priced = rows.select(
        c("sku.id").alias("sku"),
        costs.to_base(costs.net_cost(c("cost"), c("credits")), c("currency_conversion_rate")).alias("net"),
        c("usage.amount_in_pricing_units").alias("units"),
        F.when(committed, "covered").when(bare, "on_demand").alias("coverage"),
    )
    covered, on_demand = c("coverage") == "covered", c("coverage") == "on_demand"
    sums = priced.groupBy("sku").agg(
        F.count_if(covered).alias("covered_rows"),
        F.count_if(on_demand).alias("on_demand_rows"),
        F.sum(_where(covered, "net")).alias("covered_net"),
        F.sum(_where(on_demand, "net")).alias("on_demand_net"),
        F.sum(_where(covered, "units")).alias("covered_units"),
        F.sum(_where(on_demand, "units")).alias("on_demand_units"),
    )
    both = sums.filter("covered_rows > 0 AND on_demand_rows > 0")
    rounded = both.withColumns({n: F.round(n, 6) for n in ("covered_net", "on_demand_net")})
    rate = lambda kind: F.try_divide(
        c(f"{kind}_net").cast("double"), c(f"{kind}_units").cast("double")
    )
    return rounded.select(
        "sku",
        "covered_rows",
        "on_demand_rows",
        "covered_net",
        "on_demand_net",
        rate("covered").alias("covered_unit_cost"),
        rate("on_demand").alias("on_demand_unit_cost"),
    )


def coverage_gap(df: DataFrame, covered_team: str, on_demand_team: str) -> DataFrame:
    """What one team pays above another for the SKUs both use; canonical rows in."""
    teams = df.filter(F.col("team").isin(covered_team, on_demand_team))
    net = lambda team: costs.to_base(
        F.when(F.col("team") == team, F.col("net_cost")), F.col("rate")
    )
    return (
        teams.groupBy("sku")
        .agg(
            F.round(F.sum(net(covered_team)), 6).alias("covered_net"),
            F.round(F.sum(net(on_demand_team)), 6).alias("on_demand_net"),
        )
        .filter("covered_net IS NOT NULL AND on_demand_net IS NOT NULL")
        .withColumn("gap", F.col("on_demand_net") - F.col("covered_net"))
    )


def reservation_utilisation(usage: DataFrame, fees: DataFrame) -> DataFrame:
    """Per reservation, hours and cost used against the hours and fee bought.

    Each side is summed to one row per reservation before they meet; neither side's rows are lost.
    """
    used = (
        usage.filter("line_item_type = 'DiscountedUsage'")
        .groupBy("reservation_arn")
        .agg(
            F.sum("usage_amount").alias("used_hours"),
            F.sum("reservation_effective_cost").alias("used_cost"),
        )
    )
    bought = (
        fees.filter("line_item_type = 'RIFee'")
        .groupBy("reservation_arn")
        .agg(F.sum("usage_amount").alias("fee_hours"), F.sum("unblended_cost").alias("fee"))
    )
    c = F.col
    return bought.join(used, "reservation_arn", "full_outer").select(
        "reservation_arn",
        reservation_id(c("reservation_arn")).alias("reservation_id"),
        "used_hours",
        "used_cost",
        "fee_hours",
        "fee",
        F.try_divide(
            F.coalesce(c("used_hours"), F.lit(0)).cast("double"), c("fee_hours").cast("double")
        ).alias("utilisation"),
        (c("fee") - F.coalesce(c("used_cost"), F.lit(0))).alias("unused_cost"),
    )


#: Seconds of a bucket in which periods of a reservation meet.
PERIOD_BUCKET = 32 * 86400
#: Fees of a reservation up to which its usage is compared with every one of them.
FEW_PERIODS = 32
#: Shares that a reservation of very many usage rows is cut into; its fees go to each.
PERIOD_SHARES = 16


def _share(amount: Column, part: Column, whole: Column) -> Column:
    """The first ``part`` of ``whole`` seconds of an amount, floored in its sixth place."""
    product = (amount * 1_000_000).cast("decimal(26,0)") * part.cast("decimal(12,0)")
    seconds = whole.cast("decimal(12,0)")
    return ((product - F.pmod(product, seconds)) / seconds).cast("decimal(26,0)")


def _in_periods(usage: DataFrame, fees: DataFrame, hot_rows: int, few_periods: int) -> DataFrame:
    """Usage rows with every fee of their reservation whose period they overlap.

    A reservation of up to ``few_periods`` fees meets its usage as it is. Where it has more, both sides go into each
    bucket of time that they touch, and a pair counts in the first bucket that it shares. What is copied for a join is
    never broadcast: Spark judges its size from before it was copied.
    """
    span = lambda start, end: F.sequence(
        F.floor(F.col(start) / PERIOD_BUCKET), F.floor((F.col(end) - 1) / PERIOD_BUCKET)
    )
    begins = F.greatest("_s", "_from")

    def met(rows: DataFrame, fee_rows: DataFrame, more: list[str]) -> DataFrame:
        joined = rows.join(fee_rows, ["reservation_arn", *more]).filter(begins < F.least("_e", "_to"))
        if "_bucket" in more:
            joined = joined.filter(F.col("_bucket") == F.floor(begins / PERIOD_BUCKET))
        return joined.drop(*more)

    def shared(rows: DataFrame, fee_rows: DataFrame, more: list[str]) -> DataFrame:
        usual_fees = fee_rows.hint("merge") if more else fee_rows

        def heavy(hot: DataFrame) -> DataFrame:
            cut = hot.withColumn("_cut", F.pmod(F.xxhash64("line_item_id", "_s"), F.lit(PERIOD_SHARES)))
            copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PERIOD_SHARES - 1).cast("bigint")))
            return met(cut, fee_rows.withColumn("_cut", copies).hint("merge"), [*more, "_cut"])

        return split_hot(rows, ["reservation_arn"], lambda usual: met(usual, usual_fees, more), heavy, hot_rows)

    def direct(rows: DataFrame, fee_rows: DataFrame) -> DataFrame:
        return shared(rows, fee_rows, [])

    def bucketed(rows: DataFrame, fee_rows: DataFrame) -> DataFrame:
        in_buckets = lambda df, start, end: df.withColumn("_bucket", F.explode(span(start, end)))
        return shared(in_buckets(rows, "_s", "_e"), in_buckets(fee_rows, "_from", "_to"), ["_bucket"])

    many = hot_keys(fees, ["reservation_arn"], few_periods)
    if many.isEmpty():
        return direct(usage, fees)
    hashed = [df.withColumn("_hash", F.xxhash64("reservation_arn")) for df in (usage, fees)]
    part = lambda how: [df.join(many, "_hash", how).drop("_hash") for df in hashed]
    return direct(*part("left_anti")).unionByName(bucketed(*part("left_semi")))


def reservation_by_period(
    usage: DataFrame, fees: DataFrame, hot_rows: int = HOT_ROWS, few_periods: int = FEW_PERIODS
) -> DataFrame:
    """Per reservation fee, the hours and cost of its reservation's usage that fall into its own period.

    Usage that reaches beyond a period counts in proportion of its seconds, floored in the sixth place such that
    adjoining periods share it without loss. Where periods of one reservation overlap, usage counts in each: its
    hours were bought twice. Usage without a span, and fees without a period, match nothing; a fee without usage
    stays, with zero hours.
    """
    c = F.col
    seconds = lambda column: F.unix_seconds(F.try_to_timestamp(column))
    used = usage.filter("line_item_type = 'DiscountedUsage' AND reservation_arn IS NOT NULL").select(
        "reservation_arn", "line_item_id", seconds("usage_start").alias("_s"), seconds("usage_end").alias("_e"),
        c("usage_amount").alias("_hours"), c("reservation_effective_cost").alias("_cost"),
    ).filter("_e > _s")
    bought = fees.filter("line_item_type = 'RIFee'").select(
        "reservation_arn", c("line_item_id").alias("fee_id"), c("usage_start").alias("period_start"),
        c("usage_end").alias("period_end"), c("usage_amount").alias("fee_hours"), c("unblended_cost").alias("fee"),
    )
    periods = bought.select(
        "reservation_arn", "fee_id", seconds("period_start").alias("_from"), seconds("period_end").alias("_to")
    ).filter("_to > _from")
    pairs = _in_periods(used, periods, hot_rows, few_periods)
    whole = c("_e") - c("_s")
    until, since = F.least("_e", "_to") - c("_s"), F.greatest("_s", "_from") - c("_s")
    part = lambda amount: _share(amount, until, whole) - _share(amount, since, whole)
    sums = pairs.groupBy("fee_id").agg(
        F.count(F.lit(1)).alias("usage_rows"), F.sum(part(c("_hours"))).alias("_h"), F.sum(part(c("_cost"))).alias("_c")
    ).withColumnRenamed("fee_id", "_fee_id")
    millionth = F.lit("0.000001").cast("decimal(7,6)")
    money = lambda name: (F.coalesce(c(name), F.lit(0)).cast("decimal(31,0)") * millionth).cast("decimal(32,6)")
    return bought.join(sums, c("fee_id") == c("_fee_id"), "left").select(
        "fee_id", "reservation_arn", "period_start", "period_end",
        F.coalesce("usage_rows", F.lit(0)).alias("usage_rows"), money("_h").alias("used_hours"),
        money("_c").alias("used_cost"), "fee_hours", "fee",
        F.try_divide(money("_h").cast("double"), c("fee_hours").cast("double")).alias("utilisation"),
    )


def round_trip(
    published: DataFrame,
    consumed: DataFrame,
    keys: Sequence[str],
    bound: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per published message: its first consumption within ``bound``, or a time-out.

    ``published`` has ``published_at``, ``consumed`` has ``consumed_at``. Both are sorted together
    and each message takes the next consumption of its key, so no pairs are formed: a key with
    many messages on both sides costs their sum, not their product.
    """
    null_time = F.lit(None).cast(consumed.schema["consumed_at"].dataType)
    # At the same instant, the message sorts before its consumption.
    sent = published.withColumns(
        {"_at": F.col("published_at"), "_kind": F.lit(0), "_consumed": null_time}
    )
    received = consumed.select(
        *keys, F.col("consumed_at").alias("_at"), F.lit(1).alias("_kind"),
        F.col("consumed_at").alias("_consumed"),
    )
    missing = None
    for key in keys:
        missing = F.col(key).isNull() if missing is None else missing | F.col(key).isNull()
    # A null key matches nothing: such messages time out, such consumptions belong to none.
    lost = sent.filter(missing).withColumn("_next", null_time)
    both = sent.filter(~missing).unionByName(received.filter(~missing), allowMissingColumns=True)

    def usual(rows: DataFrame) -> DataFrame:
        # Latest first: a running minimum is then the nearest consumption that follows.
        w = Window.partitionBy(*keys).orderBy(F.desc("_at"), F.desc("_kind"))
        w = w.rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("_next", F.min("_consumed").over(w))

    def heavy(rows: DataFrame) -> DataFrame:
        cut = chunked(rows, [*keys, "_at", "_kind"])
        spans = span_summary(cut, keys, F.min("_consumed").alias("_first"))
        later = Window.partitionBy(*keys).orderBy(F.desc(CHUNK))
        spans = spans.withColumn("_later", F.min("_first").over(before(later))).drop("_first")
        w = Window.partitionBy(CHUNK, *keys).orderBy(F.desc(PLACE))
        w = w.rowsBetween(Window.unboundedPreceding, 0)
        near = cut.withColumn("_near", F.min("_consumed").over(w))
        return (
            join_spans(near, spans, keys)
            .filter("_kind = 0")
            .withColumn("_next", F.coalesce("_near", "_later"))
            .drop("_near", "_later", CHUNK, PLACE)
        )

    matched = split_hot(both, keys, usual, heavy, hot_rows).filter("_kind = 0").unionByName(lost)
    in_time = F.col("_next") <= F.col("published_at") + F.expr(f"INTERVAL {bound}")
    return matched.select(
        *published.columns, F.when(in_time, F.col("_next")).alias("consumed_at")
    ).select(
        "*",
        elapsed_millis(F.col("published_at"), F.col("consumed_at")).alias("latency_ms"),
        F.col("consumed_at").isNull().alias("timed_out"),
    )


def sequence_audit(
    events: DataFrame,
    key: str,
    created: str,
    arrival: str,
    earlier: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per event, its number of arrival within the key and how it relates to the newest before it.

    ``arrival`` is the position in the log. An event created before one that arrived earlier is out
    of order; otherwise ``gap_ms`` tells how long the key was silent. ``earlier`` is the summary of
    what arrived before (see ``arrival_summary``); it sorts ahead of the events as one more row.
    """
    keys = [key]
    rows = events.withColumn("_arrived", F.lit(1).cast("bigint"))
    if earlier is not None:
        here = events.select(F.col(key).alias("_here")).distinct()
        summary = earlier.join(here, F.col("key").eqNullSafe(F.col("_here")), "left_semi").select(
            F.col("key").alias(key), F.col("newest").alias(created), F.col("arrived").alias("_arrived")
        )
        rows = rows.unionByName(summary, allowMissingColumns=True)

    def usual(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(F.asc_nulls_first(arrival))
        return rows.withColumns({
            "arrival_no": F.sum("_arrived").over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "_newest": F.max(created).over(before(w)),
        })

    def heavy(rows: DataFrame) -> DataFrame:
        cut = chunked(rows, [F.col(key), F.asc_nulls_first(arrival)])
        spans = span_summary(
            cut, keys, F.sum("_arrived").alias("_rows"), F.max(created).alias("_top")
        )
        previous = before(span_window(keys))
        spans = spans.withColumns({
            "_rows_before": F.coalesce(F.sum("_rows").over(previous), F.lit(0)),
            "_top_before": F.max("_top").over(previous),
        }).drop("_rows", "_top")
        w = chunk_window(keys)
        near = cut.withColumns({
            "_row": F.sum("_arrived").over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "_near": F.max(created).over(before(w)),
        })
        return (
            join_spans(near, spans, keys)
            .withColumns({
                "arrival_no": F.col("_rows_before") + F.col("_row"),
                "_newest": F.greatest("_near", "_top_before"),
            })
            .drop("_row", "_near", "_rows_before", "_top_before", CHUNK, PLACE)
        )

    numbered = split_hot(rows, keys, usual, heavy, hot_rows).filter(F.col(arrival).isNotNull())
    late = F.coalesce(F.col(created) < F.col("_newest"), F.lit(False))
    gap = elapsed_millis(F.col("_newest"), F.col(created))
    audited = numbered.withColumns({"out_of_order": late, "gap_ms": F.when(~late, gap)})
    return audited.drop("_newest", "_arrived")


def arrival_summary(events: DataFrame, key: str, created: str) -> DataFrame:
    """Per key, how many events arrived and the newest creation time among them."""
    return events.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("arrived"), F.max(created).alias("newest")
    )


def merge_summaries(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("key").agg(
        F.sum("arrived").alias("arrived"), F.max("newest").alias("newest")
    )
