"""One query per operator, each over whole tables.

Results leave the library flat: decimals as doubles rounded to six places, UTC times without zone.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import schemas
from tallybook.functions import costs, text
from tallybook.operators import expectations, normalize, outbox, paging, reconcile, restate
from tallybook.session import new_table_path, owned_tables, prepare, released_shuffles
from tallybook.sources import adapters, eventlog, feeds, landed
from tallybook.sources.adapters import cur_like, fees_like, gcp_like, outbox_like, table
from tallybook.streaming import sinks, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOPIC_PREFIX = schemas.topics()["events"]
PAYLOAD = T.StructType([T.StructField("k", T.LongType())])
RETENTION_CUTOFF = "2024-01-15 00:00:00"
ROUND_TRIP_BOUND = "1 HOUR"


def query(build: Query) -> Query:
    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(build(prepare(spark), sf_dir.rstrip("/")))

    QUERIES[build.__name__] = run
    return run


def report(df: DataFrame) -> DataFrame:
    """Plain column types for comparison with another engine."""
    columns = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = F.round(c, 6).cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


# --- costs and spend -----------------------------------------------------------------------------


@query
def net_cost_by_team(spark, sf_dir):
    c = F.col
    rate = c("currency_conversion_rate")
    rows = gcp_like(spark, sf_dir).select(
        costs.tag(c("labels"), "team").alias("team"),
        costs.to_base(c("cost"), rate).alias("cost"),
        costs.to_base(costs.credit_total(c("credits")), rate).alias("credit"),
        costs.to_base(costs.net_cost(c("cost"), c("credits")), rate).alias("net"),
    )
    return rows.groupBy("team").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("cost").alias("cost_base"),
        F.sum("credit").alias("credit_base"),
        F.sum("net").alias("net_base"),
    )


@query
def effective_cost_by_type(spark, sf_dir):
    items = cur_like(spark, sf_dir).unionByName(fees_like(spark, sf_dir))
    return normalize.cost_views(normalize.canonical_aws(items), ["charge_class"])


@query
def gcp_charge_classes(spark, sf_dir):
    return normalize.spend_by(normalize.canonical_gcp(gcp_like(spark, sf_dir)), ["charge_class"])


def _canonical(spark, sf_dir):
    return normalize.canonical(cur_like(spark, sf_dir), gcp_like(spark, sf_dir))


@query
def canonical_spend_daily(spark, sf_dir):
    spend = normalize.spend_by(_canonical(spark, sf_dir), ["provider", "account", "team"], "day")
    return normalize.with_provider_name(spend)


@query
def spend_by_hour(spark, sf_dir):
    return normalize.spend_by(_canonical(spark, sf_dir), ["provider"], "hour")


@query
def spend_by_account(spark, sf_dir):
    return normalize.spend_by(_canonical(spark, sf_dir), ["provider", "account", "team"])


@query
def canonical_rows(spark, sf_dir):
    return _canonical(spark, sf_dir)


@query
def credit_types(spark, sf_dir):
    return normalize.credit_types(gcp_like(spark, sf_dir))


@query
def credit_coverage(spark, sf_dir):
    c = F.col
    return (
        gcp_like(spark, sf_dir)
        .groupBy(costs.tag(c("labels"), "team").alias("team"))
        .agg(
            F.count_if(costs.has_credit(c("credits"), costs.COMMITTED)).alias("committed_rows"),
            F.count_if(F.size("credits") == 0).alias("bare_rows"),
        )
    )


@query
def covered_vs_on_demand(spark, sf_dir):
    return reconcile.coverage_by_sku(gcp_like(spark, sf_dir))


@query
def team_coverage_gap(spark, sf_dir):
    rows = normalize.canonical_gcp(gcp_like(spark, sf_dir))
    return reconcile.coverage_gap(rows, "NATION_1", "NATION_2")


@query
def reservation_utilisation(spark, sf_dir):
    return reconcile.reservation_utilisation(cur_like(spark, sf_dir), fees_like(spark, sf_dir))


def _fees_by_period(spark, sf_dir):
    """Two fees for each reservation: periods that overlap, and begin and end within usage."""
    fees = fees_like(spark, sf_dir)
    number = F.regexp_extract("reservation_arn", r"(\d+)$", 1).cast("bigint")
    at = lambda day, hours: text.vendor_time(
        F.lit(day).cast("timestamp") + F.make_dt_interval(hours=(number * hours % 977).cast("int"))
    )
    periods = F.explode(F.array(
        F.struct(F.lit("a").alias("name"), F.lit("1995-01-01T00:00:00Z").alias("start"), at("1998-03-01", 31).alias("end")),
        F.struct(F.lit("b").alias("name"), at("1998-02-01", 17).alias("start"), F.lit("2002-01-01T00:00:00Z").alias("end")),
    ))
    return fees.withColumn("_period", periods).withColumns({
        "line_item_id": F.concat_ws("-", "line_item_id", "_period.name"),
        "usage_start": F.col("_period.start"), "usage_end": F.col("_period.end"),
    }).drop("_period")


@query
def reservation_by_period(spark, sf_dir):
    return reconcile.reservation_by_period(cur_like(spark, sf_dir), _fees_by_period(spark, sf_dir))


@query
def apportioned_spend(spark, sf_dir):
    """Spend per provider and day, each row split over the days that it spans."""
    parts = normalize.apportioned(_canonical(spark, sf_dir), ["net_cost"], "day")
    return parts.groupBy("provider", F.col("part_start").alias("day")).agg(
        F.count(F.lit(1)).alias("parts"), normalize.in_base("net_cost").alias("net_cost")
    )


@query
def restated_spend(spark, sf_dir):
    """Daily spend after a second delivery, taken in twice, that doubles adjustments and withdraws taxes."""
    path = new_table_path(spark, "restated")
    keys = ["provider", "account"]
    rows = _canonical(spark, sf_dir)
    old = rows.filter(F.col("charge_class").isin("tax", "adjustment"))
    new = rows.filter("charge_class = 'adjustment'").withColumn("net_cost", costs.money(F.col("net_cost") * 2))
    restate.take_in(path, "first", None, rows, keys)
    for _ in range(2):
        restate.take_in(path, "second", old, new, keys)
    return restate.spend(spark, path, keys)


@query
def non_base_currency(spark, sf_dir):
    rows = normalize.canonical_gcp(gcp_like(spark, sf_dir)).filter(costs.not_in_base(F.col("currency")))
    return rows.groupBy("currency", "team").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("net_cost").alias("net_local"),
        normalize.in_base("net_cost").alias("net_base"),
    )


@query
def machine_families(spark, sf_dir):
    """Machine from each vendor's text; GCP usage in pricing units."""
    return _canonical(spark, sf_dir).groupBy("provider", "machine", "usage_unit").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("usage_amount").alias("usage_amount")
    )


@query
def usage_windows(spark, sf_dir):
    rows = normalize.usage_window(cur_like(spark, sf_dir).select("line_item_id", "time_interval"))
    return rows.select("line_item_id", "window_start", "window_end", "window_seconds")


@query
def line_item_types(spark, sf_dir):
    items = cur_like(spark, sf_dir).unionByName(fees_like(spark, sf_dir))
    return items.select("line_item_type").distinct()


@query
def commitment_names(spark, sf_dir):
    """Names built for one reservation and one commitment per part, and parsed back."""
    c = F.col
    suffix = F.sha2(c("p_partkey").cast("string"), 256)
    names = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("ri-"), F.substring(suffix, 1, 12)).alias("reservation"),
        F.concat(
            F.lit("projects/"), c("p_brand"), F.lit("/regions/"), c("p_type"), F.lit("/commitments/cud-"), F.substring(suffix, 1, 8)
        ).alias("commitment"),
    )
    return names.select(
        "*",
        text.reservation_id(F.concat(F.lit("arn:aws:ec2:reserved-instances/"), c("reservation"))).alias(
            "parsed_reservation"
        ),
        text.commitment_id(c("commitment")).alias("parsed_commitment"),
        text.commitment_project(c("commitment")).alias("parsed_project"),
    )


# --- feeds and pages -----------------------------------------------------------------------------

LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _feed_pages(spark, sf_dir):
    return paging.assign_pages(table(spark, sf_dir, "lineitem"), LINE_ORDER, schemas.LINE_ITEM_PAGE_SIZE)


def _feed_page(spark, sf_dir, token, size):
    feed = paging.number_feed(table(spark, sf_dir, "lineitem"), LINE_ORDER)
    return paging.page(feed, token, size).select(*LINE_ORDER, "next_token")


@query
def feed_pages(spark, sf_dir):
    return _feed_pages(spark, sf_dir).select(*LINE_ORDER, "page", "page_row")


@query
def feed_page_sizes(spark, sf_dir):
    return paging.page_sizes(_feed_pages(spark, sf_dir), schemas.LINE_ITEM_PAGE_SIZE)


@query
def feed_page_n(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return paging.early_page(items, LINE_ORDER, " 15 ", schemas.LINE_ITEM_PAGE_SIZE).select(*LINE_ORDER, "next_token")


@query
def feed_page_deep(spark, sf_dir):
    return _feed_page(spark, sf_dir, "+5995", schemas.BILLING_ROW_PAGE_SIZE)


@query
def page_walk_check(spark, sf_dir):
    """Rows and pages of a whole walk, and the keys it returned too often or not at all."""
    pages = _feed_pages(spark, sf_dir)
    return _walk_report(pages, table(spark, sf_dir, "lineitem"))


@query
def page_walk_faults(spark, sf_dir):
    """The same of a walk that lost every page's last row and returned each third page twice."""
    pages = _feed_pages(spark, sf_dir)
    last = schemas.LINE_ITEM_PAGE_SIZE - 1
    walked = pages.filter(F.col("page_row") < last)
    walked = walked.unionByName(walked.filter(F.col("page") % 3 == 0))
    return _walk_report(walked, table(spark, sf_dir, "lineitem"))


def _walk_report(pages, source):
    differing = paging.page_walk_diff(pages, source, LINE_ORDER).agg(F.count(F.lit(1)).alias("differing_keys"))
    walk = pages.agg(F.count(F.lit(1)).alias("walked_rows"), (F.max("page") + 1).alias("pages"))
    return walk.join(differing)  # one row each


def _write_envelopes(paged, size, items, token, write):
    """The page envelopes of a walk handed to ``write``, a range of pages after the other."""
    for part in paging.page_ranges(paged, size):
        write(feeds.to_pages(part, "page", "page_row", size, items, token, paged))


def _line_item_envelopes(spark, sf_dir, write):
    """The flat feed's page envelopes, written; what they are made from is removed."""
    size = schemas.LINE_ITEM_PAGE_SIZE
    with owned_tables(spark), released_shuffles(spark):
        paged = paging.assign_pages(cur_like(spark, sf_dir), [*schemas.LINE_ITEM.fieldNames()], size)
        period = paged.agg(F.substring(F.max("usage_start"), 1, 7)).first()[0]
        landed_in = lambda envelopes: write(envelopes.withColumn("billingPeriod", F.lit(period)))
        _write_envelopes(feeds.wire_named(paged), size, "lineItems", "nextToken", landed_in)


def _paged_items(rows):
    return feeds.readable(rows).select(
        "billingPeriod", "nextToken", "position", "line_item_id", "line_item_type",
        "unblended_cost", "reservation_effective_cost", "tag_team",
    )


@query
def line_item_pages(spark, sf_dir):
    """Flat feed landed as page envelopes in vendor JSON, read back and flattened."""
    path = new_table_path(spark, "line-item-pages")
    size = schemas.LINE_ITEM_PAGE_SIZE
    _line_item_envelopes(spark, sf_dir, lambda pages: feeds.landing(pages, size).mode("append").json(path))
    return _paged_items(feeds.explode_pages(feeds.read_line_item_pages(spark, path), "lineItems"))


@query
def stream_pages(spark, sf_dir):
    """The same feed landed in quarters and followed by its tokens, the third quarter there before the second.

    Three runs: one up to the gap, one when it is filled, one for the rest.
    """
    size, (path, checkpoint) = schemas.LINE_ITEM_PAGE_SIZE, _paths(spark, "followed-pages")
    pages_path, landings = new_table_path(spark, "envelopes"), new_table_path(spark, "landings")
    packed = lambda envelopes: envelopes.write.mode("append").option("compression", "zstd").parquet(pages_path)
    _line_item_envelopes(spark, sf_dir, packed)
    pages = spark.read.parquet(pages_path)
    held = pages.agg(F.count(F.lit(1)), F.sum(F.size("lineItems"))).first()
    edges = sorted({held[0] * k // 4 * size for k in range(4)} | {held[1] or 0})
    quarters = list(zip(edges, edges[1:]))
    following = F.coalesce(F.col("nextToken").cast("bigint"), F.lit(held[1]))
    for run in (quarters[:1] + quarters[2:3], quarters[1:2], quarters[3:]):
        for first, end in run:
            landed.land(pages.filter((following > first) & (following <= end)), landings, first, end, size)
        envelopes = feeds.parse_pages(landed.follow(spark, landings), schemas.LINE_ITEM_PAGE)
        items = _paged_items(feeds.explode_pages(envelopes, "lineItems"))
        sinks.write_rows(items, path, checkpoint)
    return sinks.written(spark, path, items.schema)


@query
def billing_row_pages(spark, sf_dir):
    """Nested feed landed as page envelopes, read back, flattened and costed."""
    size = schemas.BILLING_ROW_PAGE_SIZE
    rows = gcp_like(spark, sf_dir)
    order = [F.col(c) for c in ("project.id", "sku.id", "usage_start_time", "cost", *rows.columns)]
    path = new_table_path(spark, "billing-row-pages")
    with owned_tables(spark), released_shuffles(spark):
        paged = paging.assign_pages(rows, order, size)
        _write_envelopes(paged, size, "rows", "nextPageToken", lambda pages: feeds.landing(pages, size).mode("append").json(path))
    back = feeds.explode_pages(feeds.read_billing_row_pages(spark, path), "rows")
    c = F.col
    return back.groupBy(
        c("project.id").alias("project"), c("nextPageToken").isNull().alias("last_page")
    ).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.size("credits") == 0).alias("bare_rows"),
        F.sum(costs.net_cost(c("cost"), c("credits"))).alias("net_cost"),
    )


@query
def token_decode(spark, sf_dir):
    """Tokens of every spelling, decoded against the size of the feed they belong to."""
    events = table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    kind = F.col("event_type")
    token = (
        F.when(kind == "view", number)
        .when(kind == "click", F.concat(F.lit(" +"), number, F.lit(" ")))
        .when(kind == "error", F.concat(F.lit("-"), number))
        .when(kind == "signup", F.concat(number, F.lit(".5")))
        .when(F.col("value") > 10, F.concat(number, F.lit("99999999999")))
        .when(F.col("value") > 5, F.lit("  "))
    )
    size = F.lit(events.count() - 100)
    return events.select("event_id", token.alias("token")).select(
        "event_id",
        text.or_default(F.col("token"), "none").alias("token"),
        text.decode_token(F.col("token"), size).alias("position"),
    )


@query
def json_roundtrip(spark, sf_dir):
    """Line items and fees written as vendor JSON, parsed back; absent fields stay out of the text."""
    items = cur_like(spark, sf_dir).unionByName(fees_like(spark, sf_dir))
    texts = feeds.to_vendor_json(items)
    keys = texts.select(F.size(F.json_object_keys("value")).alias("key_count"), "value")
    back = keys.select("key_count", F.from_json("value", schemas.LINE_ITEM_WIRE).alias("item"))
    return feeds.readable(back.select("key_count", "item.*")).select(
        "key_count", *schemas.LINE_ITEM.fieldNames()
    )


@query
def landed_line_items(spark, sf_dir):
    """Line items written as JSON lines under wire names and scanned with the fixed schema."""
    path = new_table_path(spark, "line-items")
    feeds.write_line_items(cur_like(spark, sf_dir), path)
    return feeds.read_line_items(spark, path)


@query
def landed_billing_rows(spark, sf_dir):
    """Nested rows written as JSON lines and scanned with the fixed schema."""
    path = new_table_path(spark, "billing-rows")
    feeds.write_billing_rows(gcp_like(spark, sf_dir), path)
    c = F.col
    return feeds.read_billing_rows(spark, path).select(
        c("project.id").alias("project"),
        c("project.name").alias("project_name"),
        c("service.description").alias("service"),
        c("sku.id").alias("sku"),
        c("sku.description").alias("sku_text"),
        "usage_start_time", "usage_end_time", "cost", "currency", "cost_type",
        c("usage.amount").alias("raw_amount"),
        F.size("labels").alias("label_count"),
        F.size("credits").alias("credit_count"),
    )


# --- deduplication, cursors, outbox --------------------------------------------------------------


def _with_line_id(items):
    return items.withColumn("line_item_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))


@query
def dedup_line_items(spark, sf_dir):
    items = _with_line_id(table(spark, sf_dir, "lineitem"))
    return outbox.dedup(items, ["line_item_id"], LINE_ORDER)


@query
def repeated_line_items(spark, sf_dir):
    return expectations.repeated(_with_line_id(table(spark, sf_dir, "lineitem")), ["line_item_id"])


@query
def seen_anti_join(spark, sf_dir):
    """Line items whose id was not yet processed, those returned counting as processed."""
    items = _with_line_id(table(spark, sf_dir, "lineitem"))
    seen = items.filter("l_returnflag = 'R'")
    return reconcile.drop_seen(items, seen, ["line_item_id"])


def _cursors(spark, sf_dir):
    updates = adapters.cursor_updates(spark, sf_dir)
    half = F.col("updated_at") < F.lit("2024-01-15").cast("timestamp")
    current = outbox.latest(updates.filter(half), ["source"], ["updated_at", "last_token"])
    return outbox.upsert_cursor(current, updates.filter(~half))


@query
def cursor_latest(spark, sf_dir):
    return _cursors(spark, sf_dir)


@query
def cursor_lookup(spark, sf_dir):
    """The events the cursors point at."""
    tokens = _cursors(spark, sf_dir).select(F.col("last_token").alias("id"))
    return reconcile.lookup(outbox_like(spark, sf_dir), tokens, ["id"])


@query
def resume_after_token(spark, sf_dir):
    """What is left to read once a cursor is at the middle of the feed."""
    events = table(spark, sf_dir, "events")
    middle = events.agg(F.floor(F.max("event_id") / 2)).first()[0]
    return streams.after_token(events, "event_id", middle)


def _routed_columns(log):
    c = F.col
    return log.select(
        "topic",
        "key",
        costs.tag(c("headers"), "id").alias("id"),
        costs.tag(c("headers"), "type").alias("type"),
        F.from_json("value", PAYLOAD)["k"].alias("k"),
        c("timestamp").alias("created_at"),
    )


@query
def outbox_routed(spark, sf_dir):
    return _routed_columns(outbox.route(outbox_like(spark, sf_dir), TOPIC_PREFIX))


@query
def payload_variant(spark, sf_dir):
    """Payload fields without a schema: one that is there and one that is not."""
    return outbox_like(spark, sf_dir).select(
        "id",
        outbox.payload_field("payload", "$.k", "bigint").alias("k"),
        outbox.payload_field("payload", "$.missing", "string").alias("missing"),
    )


@query
def topic_leakage(spark, sf_dir):
    """Events found on a foreign topic, after errors of high value were also sent to sign-ups."""
    events = outbox_like(spark, sf_dir)
    high = table(spark, sf_dir, "events").filter("event_type = 'error' AND value > 20")
    leaked = adapters.outbox_of(high).withColumn("aggregate_type", F.lit("signup"))
    log = _routed_columns(outbox.route(events.unionByName(leaked), TOPIC_PREFIX))
    return outbox.topic_leakage(log)


@query
def outbox_ordered(spark, sf_dir):
    return outbox.ordered(outbox_like(spark, sf_dir)).select("aggregate_id", "sequence", "id", "created_at")


@query
def creation_order(spark, sf_dir):
    return outbox.in_creation_order(outbox_like(spark, sf_dir)).select("id", "created_at")


@query
def retention_kept(spark, sf_dir):
    cutoff = F.lit(RETENTION_CUTOFF).cast("timestamp")
    return outbox.retain(outbox_like(spark, sf_dir), cutoff)


@query
def retention_by_date(spark, sf_dir):
    """The same from a table partitioned by day, of which earlier days are not read."""
    path = new_table_path(spark, "events-by-date")
    outbox.write_by_date(outbox_like(spark, sf_dir), path)
    cutoff = F.lit(RETENTION_CUTOFF).cast("timestamp")
    return outbox.retained(spark, path, cutoff).drop("created_date")


@query
def cdc_capture(spark, sf_dir):
    snapshot, changes = adapters.change_log(spark, sf_dir)
    log = outbox.capture(snapshot, changes, ["ingestion.outbox_event"])
    return log.select("id", "op", "type", "payload", "created_at")


@query
def state_events(spark, sf_dir):
    """Orders as state changes with an event each, whose id a replay reproduces."""
    orders = table(spark, sf_dir, "orders")
    c = F.col
    return outbox.to_events(
        orders,
        F.lit("order"),
        c("o_orderkey"),
        F.concat(F.lit("OrderStatus"), c("o_orderstatus")),
        ["o_custkey", "o_orderpriority"],
        c("o_orderdate").cast("timestamp"),
    )


@query
def marker_events(spark, sf_dir):
    events = outbox_like(spark, sf_dir)
    return events.filter((F.col("type") == "click") & F.col("payload").contains('"k": 7'))


@query
def first_marker_event(spark, sf_dir):
    events = outbox_like(spark, sf_dir).filter(F.col("payload").contains('"k": 7'))
    return events.orderBy("created_at", "id").limit(1)


@query
def round_trip(spark, sf_dir):
    """Each view, and the user's next click if it came within the bound."""
    events = table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    published = events.filter("event_type = 'view'").select("user_id", at.alias("published_at"), "event_id")
    consumed = events.filter("event_type = 'click'").select("user_id", at.alias("consumed_at"))
    return reconcile.round_trip(published, consumed, ["user_id"], ROUND_TRIP_BOUND)


def _arrivals(events):
    """Events that were created some hours before they arrived."""
    lag = F.make_dt_interval(mins=(F.col("value") * 60).cast("int"))
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("aggregate_id"),
        (F.col("ts").cast("timestamp") - lag).alias("created_at"),
        F.col("event_id").alias("arrival"),
    )


@query
def sequence_audit(spark, sf_dir):
    arrivals = _arrivals(table(spark, sf_dir, "events"))
    audit = reconcile.sequence_audit(arrivals, "aggregate_id", "created_at", "arrival")
    return _audit_columns(audit)


def _audit_columns(audit):
    return audit.select("id", F.col("aggregate_id").alias("key"), "arrival_no", "out_of_order", "gap_ms")


def _with_faults(events):
    """Outbox rows of which errors have a cut-off payload and sign-ups a field of another type."""
    kind = F.col("type")
    payload = (
        F.when(kind == "error", F.expr("substring(payload, 1, length(payload) - 1)"))
        .when(kind == "signup", F.lit('{"k": "many"}'))
        .otherwise(F.col("payload"))
    )
    return events.withColumn("payload", payload)


@query
def quarantine_rows(spark, sf_dir):
    rows = streams.judged(_with_faults(outbox_like(spark, sf_dir)), PAYLOAD)
    bad = F.col("_bad")
    return rows.select(
        "id", bad.alias("quarantined"), F.when(~bad, F.col("_body.k")).alias("k"),
        F.when(bad, F.col("payload")).alias("payload"),
    )


# --- checks --------------------------------------------------------------------------------------


def _line_ids(spark, sf_dir):
    """The ids of the flat feed alone, without the joins that its other columns need."""
    lines = table(spark, sf_dir, "lineitem")
    fees = lines.filter("l_returnflag = 'R'").select("l_partkey").distinct()
    return lines.filter("l_linestatus = 'O'").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_item_id")).unionAll(
        fees.select(F.concat(F.lit("fee-"), F.col("l_partkey").cast("string")))
    )


@query
def table_checks(spark, sf_dir):
    """Line items and outbox rows against their rules, one pass each."""
    c = F.col
    items = cur_like(spark, sf_dir).unionByName(fees_like(spark, sf_dir))
    every, some = expectations.value_set("line_item_type", list(costs.AWS_CHARGE_CLASS))
    every |= {
        "id_not_blank": text.not_blank(c("line_item_id")),
        "reserved_costs_nothing": (c("line_item_type") != "DiscountedUsage") | (c("unblended_cost") == 0),
        "fee_has_no_team": (c("line_item_type") != "RIFee") | c("tag_team").isNull(),
        "effective_cost_positive": c("reservation_effective_cost") > 0,
    }
    some["any_free_row"] = c("unblended_cost") == 0
    rules = expectations.table_rules(schemas.OUTBOX, schemas.OUTBOX_MAX_LENGTH)
    rules = {f"outbox_{name}": rule for name, rule in rules.items()}
    events = outbox_like(spark, sf_dir)
    return (
        expectations.check(items, every, some)
        .unionByName(expectations.check(events, rules))
        .unionByName(expectations.unique(_line_ids(spark, sf_dir), "line_item_id_unique", ["line_item_id"]))
        .unionByName(expectations.unique_number(table(spark, sf_dir, "events"), "event_id_unique", "event_id"))
    )


# --- streams -------------------------------------------------------------------------------------


def _paths(spark, label):
    return new_table_path(spark, label), new_table_path(spark, f"{label}-checkpoint")


@query
def spend_windows(spark, sf_dir):
    """Hourly event counts and values per type from a stream of four batches, one current row per window."""
    path, checkpoint = _paths(spark, "windows")
    events, part = _parts(spark, sf_dir)
    timed = adapters.landed_stream(spark, events, part, 4).withColumn("ts", F.col("ts").cast("timestamp"))
    value = F.col("value").cast(schemas.MONEY)
    windows = streams.windowed_spend(timed, "ts", value, ["event_type"], "1 hour", "1 day")
    streams.keep_windows(windows, ["event_type"], path, checkpoint)
    return streams.current_windows(spark, path, windows.schema)


@query
def stream_route_dedup(spark, sf_dir):
    """Every event delivered twice, deduplicated by id and routed."""
    path, checkpoint = _paths(spark, "routed")
    events = adapters.outbox_of(adapters.event_stream(spark, sf_dir))
    twice = events.withColumn("_delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_delivery")
    once = streams.dedup(twice, "id", "created_at", "1 day")
    sinks.write_rows(outbox.route(once, TOPIC_PREFIX), path, checkpoint)
    return _routed_columns(sinks.written(spark, path))


def _parts(spark, sf_dir, parts=4):
    """The events, and the quarter of the table, by id, that each belongs to."""
    events = table(spark, sf_dir, "events")
    top = events.agg(F.max("event_id") + 1).first()[0]
    return events, F.floor(F.col("event_id") * parts / top)


@query
def stream_outbox_commit(spark, sf_dir):
    """State changes and their events of four batches, written together; each batch's state of its users, and its events."""
    path, checkpoint = _paths(spark, "outbox")
    events, part = _parts(spark, sf_dir)
    # a delivery is a file, which names its number, and a file is a batch
    stream = adapters.landed_stream(spark, events.withColumn("batch_id", part), F.col("batch_id"), 4)
    state = F.struct(F.col("user_id"), F.col("event_id").alias("last_event"))
    streams.append_units(adapters.outbox_of(stream, state.alias("state"), F.col("batch_id")), path, checkpoint)
    state = streams.appended(spark, path, "state").groupBy("user_id", "batch_id").agg(F.max("last_event").alias("last_event"))
    state = state.select(
        F.lit("state").alias("output"), F.col("user_id").cast("string").alias("key"),
        F.col("last_event").cast("string").alias("value"), "batch_id",
    )
    written = streams.appended(spark, path, "events").select(
        F.lit("events").alias("output"), F.col("id").alias("key"), F.col("payload").alias("value"), "batch_id"
    )
    return state.unionByName(written)


@query
def stream_replay(spark, sf_dir):
    """Four batches newest first, then a replay from a fresh checkpoint that is cut into one batch; each event once."""
    path, checkpoint = _paths(spark, "replay")
    events, part = _parts(spark, sf_dir)
    sinks.write_run(adapters.landed_stream(spark, events, part, 4, True), path, "first", checkpoint)
    sinks.write_run(adapters.event_stream(spark, sf_dir), path, "again", f"{checkpoint}-again")
    return sinks.current(spark, path)


@query
def stream_dedup_exact(spark, sf_dir):
    """Every event delivered twice, the copies in different batches, newest first; each comes out once."""
    path, checkpoint = _paths(spark, "exact")
    events = table(spark, sf_dir, "events")
    top = events.agg(F.max("event_id") + 1).first()[0]
    twice = adapters.outbox_of(events).withColumn("_part", F.floor(F.col("id").cast("bigint") * 4 / top))
    twice = twice.unionByName(twice.withColumn("_part", (F.col("_part") + 2) % 4))
    stream = adapters.landed_stream(spark, twice, F.col("_part"), 4, True).drop("_part")
    sinks.write_rows(streams.dedup_exact(stream, "id"), path, checkpoint)
    return sinks.written(spark, path)


@query
def late_rows(spark, sf_dir):
    """Newest files first: what is over ten days older than all that came before is put aside, not lost."""
    path, checkpoint = _paths(spark, "late")
    events, part = _parts(spark, sf_dir)
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    streams.split_late(adapters.landed_stream(spark, events, part, 4, True), "ts", "10 DAYS", path, checkpoint)
    both = [
        streams.split_rows(spark, path, name).select(
            "event_id", F.col("batch_id").cast("long").alias("batch_id"), F.lit(name).alias("output")
        )
        for name in ("rows", "late")
    ]
    return both[0].unionByName(both[1])


@query
def resume_from_cursor(spark, sf_dir):
    """What is left of each source beyond its cursor; errors have none and are read from the start."""
    events = table(spark, sf_dir, "events")
    half = events.filter((F.col("event_type") != "error") & (F.col("event_id") % 3 != 0))
    top = half.agg(F.max("event_id")).first()[0]
    read = half.filter(F.col("event_id") <= F.lit(top) / 2).select(
        F.col("event_type").alias("source"), F.col("event_id").cast("string").alias("last_token"),
        F.lit("2024-02-01").cast("timestamp").alias("updated_at"),  # one time for all: the higher token wins
    )
    cursor = outbox.upsert_cursor(read.limit(0), read)
    return streams.beyond_cursor(events, F.col("event_type"), F.col("event_id"), cursor)


def _placed_entries(spark, conf):
    """The entries of a log in files, and where each stands: in files by name, in a file by line."""
    log = spark.read.schema(schemas.EVENT_LOG).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(conf.path)
    return log.select(
        "topic", "key", "timestamp", eventlog.event_id().alias("id"), eventlog.position().alias("position"),
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"),
        F.regexp_extract(F.col("_metadata.file_path"), r"/batch_id=(\d+)/", 1).alias("batch"),
        F.monotonically_increasing_id().alias("place"),
    )


@query
def log_order_per_key(spark, sf_dir):
    """Per topic, the entries of a written log, and how many stand in their file ahead of one created earlier."""
    conf = eventlog.LogConfig("files", new_table_path(spark, "ordered-log"))
    eventlog.write_log(outbox.route(outbox_like(spark, sf_dir), TOPIC_PREFIX), conf)
    w = Window.partitionBy("topic", "key").orderBy("file", "place")
    created = F.struct("timestamp", "id")
    return _placed_entries(spark, conf).withColumn("_wrong", F.lag(created).over(w) > created).groupBy("topic").agg(
        F.count(F.lit(1)).alias("entries"), F.count_if("_wrong").alias("out_of_order")
    )


@query
def stream_log_order(spark, sf_dir):
    """A log delivered in four batches, the newest first: entries out of order within their batch, entries whose
    position is not the next of their key, and entries behind a later one of an earlier batch."""
    conf = eventlog.LogConfig("files", new_table_path(spark, "delivered-log"))
    events, part = _parts(spark, sf_dir)
    stream = adapters.outbox_of(adapters.landed_stream(spark, events, part, 4, True))
    streams.deliver(outbox.route(stream, TOPIC_PREFIX), conf, new_table_path(spark, "delivered-checkpoint"))
    key = Window.partitionBy("topic", "key")
    stands = key.orderBy(F.col("batch").cast("int"), "file", "place")
    batch = Window.partitionBy("topic", "key", "batch").orderBy("file", "place")
    created = F.struct("timestamp", "id")
    told = _placed_entries(spark, conf).withColumns({
        "_wrong": F.lag(created).over(batch) > created,
        "_jumps": F.col("position") != F.row_number().over(stands),
        "_behind": F.max("timestamp").over(stands.rowsBetween(Window.unboundedPreceding, -1)) > F.col("timestamp"),
    })
    return told.groupBy("topic").agg(
        F.count(F.lit(1)).alias("entries"), F.count_if("_wrong").alias("out_of_order"),
        F.count_if("_jumps").alias("misplaced"), F.count_if("_behind").alias("behind_later"),
    )


@query
def stream_ingest(spark, sf_dir):
    """A feed landed batch by batch; the cursors saved with it."""
    path, checkpoint = _paths(spark, "ingest")
    c = F.col
    streams.ingest(
        adapters.event_stream(spark, sf_dir), path, checkpoint,
        c("event_type"), c("event_id"), c("ts").cast("timestamp"),
    )
    return streams.read_cursor(spark, path)


@query
def stream_sequence(spark, sf_dir):
    """The arrival audit over a stream, batch by batch."""
    path, checkpoint = _paths(spark, "sequence")
    events, part = _parts(spark, sf_dir)
    arrivals = _arrivals(adapters.landed_stream(spark, events, part, 4))
    streams.sequence_audit(arrivals, path, checkpoint, "aggregate_id", "created_at", "arrival")
    return _audit_columns(sinks.written(spark, path))


@query
def stream_capture(spark, sf_dir):
    """Snapshot and change stream as one log, each event once."""
    snapshot, changes = adapters.change_log(spark, sf_dir)
    path, checkpoint = _paths(spark, "captured")
    day = F.date_diff(F.col("created_at").cast("date"), F.lit("2024-01-10").cast("date"))
    stream = adapters.landed_stream(spark, changes, F.least(F.floor(day / 6), F.lit(3)), 4, True)
    streams.capture(snapshot, stream, ["ingestion.outbox_event"], path, checkpoint)
    return streams.captured(spark, path).select("id", "op", "type", "payload", "created_at")


@query
def stream_round_trip(spark, sf_dir):
    """Messages matched with their first consumption within five seconds, over four batches newest first.

    A message's consumption follows after half its value in seconds, and again a second later, the later one
    arriving first; errors are never consumed, purchases have no id, and each fifth message was seen too early.
    """
    events, part = _parts(spark, sf_dir)
    c = F.col
    at = c("ts").cast("timestamp")
    after = lambda seconds: at + F.make_dt_interval(secs=(seconds).cast("decimal(18,6)"))
    half = c("value").cast("decimal(18,6)") / 2
    messages = events.select(
        F.when(c("event_type") != "purchase", c("event_id").cast("string")).alias("id"),
        at.alias("published_at"), c("event_id").alias("number"), part.alias("_part"),
    )
    answered = events.filter("event_type <> 'error'").select(
        F.when(c("event_type") != "purchase", c("event_id").cast("string")).alias("id"), part.alias("_part"),
        F.explode(F.array(after(half + 1), after(half), F.when(c("event_id") % 5 == 0, after(F.lit(-2))))).alias("consumed_at"),
    ).filter("consumed_at IS NOT NULL")
    path, checkpoint = _paths(spark, "round-trip")
    sent = adapters.land(messages, c("_part"), 4, newest_first=True)
    back = adapters.land(answered, c("_part"), 4, newest_first=True)

    def match():
        sides = (adapters.stream_of(spark, sent, messages.schema), adapters.stream_of(spark, back, answered.schema))
        trips = streams.round_trip(sides[0].drop("_part"), sides[1].drop("_part"), "id", 5, "60 days")
        sinks.write_rows(trips, path, checkpoint)

    match()
    # A later message on both sides moves the watermark past the end; the same checkpoint resumes.
    later = F.lit("2100-01-01").cast("timestamp")
    named = {"id": F.lit("closing"), "_part": F.lit(0).cast(messages.schema["_part"].dataType)}
    closing = messages.limit(1).withColumns({**named, "published_at": later})
    closing.write.mode("append").parquet(sent)
    closing.select("id", "_part", later.alias("consumed_at")).write.mode("append").parquet(back)
    match()
    return sinks.written(spark, path).filter("id IS DISTINCT FROM 'closing'")
