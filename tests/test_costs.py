import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.functions import costs, text
from tallybook.operators import normalize, reconcile, restate


def _by(df, *keys):
    rows = df.collect()
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}


def test_gcp_net_cost_by_team(billing_rows):
    spend = _by(normalize.spend_by(normalize.canonical_gcp(billing_rows), ["team"]), "team")
    net = {team: r["net_cost"] for team, r in spend.items()}
    assert net == {
        "orchid": Decimal("3.90"),  # 3 * (2.00 - 0.70) + 0.80 - 0.80
        "maple": Decimal("96.20"),  # 2 * 3.10 + 90
        "cedar": Decimal("9.50"),  # 4.00 * 1.25 + 5.00 - 0.45 - 0.05
    }
    assert spend["cedar"]["list_cost"] == Decimal("10.00")


def test_net_cost_of_one_covered_row(billing_rows):
    nets = billing_rows.select(costs.net_cost(F.col("cost"), F.col("credits")).alias("n"))
    assert Decimal("1.30") in {r.n for r in nets.collect()}


def test_null_and_empty_credits_sum_to_zero_but_stay_distinct(spark):
    kind = schemas.BILLING_ROW["credits"].dataType.simpleString()
    df = spark.sql(f"SELECT CAST(NULL AS {kind}) AS c UNION ALL SELECT CAST(array() AS {kind})")
    got = df.select(costs.credit_total(F.col("c")).alias("t"), F.col("c").isNull().alias("n")).collect()
    assert [r.t for r in got] == [Decimal(0), Decimal(0)]
    assert sorted(r.n for r in got) == [False, True]


def test_tag_takes_first_of_repeated_keys_and_null_when_absent(spark):
    label = "array<struct<key:string,value:string>>"
    rows = [([("team", "a"), ("team", "b")],), ([("x", "y")],), ([],), (None,)]
    df = spark.createDataFrame(rows, f"labels {label}")
    assert [r[0] for r in df.select(costs.tag(F.col("labels"), "team")).collect()] == ["a", None, None, None]


def test_aws_views(line_items):
    views = normalize.cost_views(normalize.canonical_aws(line_items), ["provider"]).first()
    assert views.cash_cost == Decimal("38.202221")  # 2.50 + 2.75 + 0.666666 + 0.055555 + 36 + 4 - 7.77
    assert views.amortised_cost == Decimal("3.102221")  # without the fee, with 3 * 0.30


def test_aws_totals_by_charge_class_and_team(line_items):
    canonical = normalize.canonical_aws(line_items)
    got = _by(normalize.cost_views(canonical, ["charge_class", "team"]), "charge_class", "team")
    assert got["covered_usage", "orchid"].amortised_cost == Decimal("0.90")
    assert got["covered_usage", "orchid"].cash_cost == 0
    assert got["covered_usage", "cedar"].cash_cost == Decimal("0.666666")
    assert (got["usage", "maple"].line_count, got["usage", "maple"].cash_cost) == (3, Decimal("2.555555"))
    assert got["usage", "cedar"].cash_cost == Decimal("2.75")
    assert (got["fee", None].cash_cost, got["fee", None].amortised_cost) == (36, 0)
    assert got["tax", None].cash_cost == 4
    assert got["credit", None].cash_cost == Decimal("-7.77")


def test_charge_class_of_commitment_fee_and_unknown(spark, billing_rows):
    classes = _by(normalize.canonical_gcp(billing_rows).groupBy("charge_class").count(), "charge_class")
    assert classes["fee"]["count"] == 1 and classes["usage"]["count"] == 8
    kinds = spark.createDataFrame(
        [("GCP", "tax"), ("GCP", "rounding_error"), ("GCP", "adjustment"), ("GCP", "?"), ("AWS", "?"), ("X", "Usage")],
        "p string, k string",
    )
    got = kinds.select(costs.charge_class(F.col("p"), F.col("k"), F.lit(None).cast("string"))).collect()
    assert [r[0] for r in got] == ["tax", "adjustment", "adjustment", "other", "other", "other"]


def test_canonical_is_one_schema(line_items, billing_rows):
    both = normalize.canonical(line_items, billing_rows)
    assert both.columns == normalize.CANONICAL
    assert both.count() == 22
    assert both.select("line_id").distinct().count() == 22
    named = _by(normalize.with_provider_name(both).select("provider", "provider_name").distinct(), "provider")
    assert {p: r.provider_name for p, r in named.items()} == schemas.PROVIDERS


def test_pricing_units_and_large_raw_amounts(billing_rows):
    machines = _by(normalize.canonical_gcp(billing_rows).groupBy("usage_unit").agg(F.sum("usage_amount").alias("u")), "usage_unit")
    assert machines["hour"].u == 6
    assert billing_rows.agg(F.max("usage.amount")).first()[0] == Decimal(2**41)


def test_machine_from_text(spark):
    df = spark.createDataFrame([("E9 Instance Core running", "BoxUsage:m6.large"), ("Boxes", "Tax")], "s string, u string")
    got = df.select(text.machine_family(F.col("s")), text.instance_type(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [("E9", "m6.large"), (None, None)]


def test_coverage_gap_between_teams(billing_rows):
    gap = reconcile.coverage_gap(normalize.canonical_gcp(billing_rows), "orchid", "maple").collect()
    assert [(r.sku, r.covered_net, r.on_demand_net, r.gap) for r in gap] == [
        ("E9 Instance Core running in Europe", Decimal("3.90"), Decimal("6.20"), Decimal("2.30"))
    ]


def test_coverage_by_sku(billing_rows):
    got = reconcile.coverage_by_sku(billing_rows).collect()
    assert [(r.sku, r.covered_rows, r.on_demand_rows) for r in got] == [("sku-e9", 3, 2)]
    assert (got[0].covered_unit_cost, got[0].on_demand_unit_cost) == (1.3, 3.1)


def test_reservation_utilisation(line_items):
    got = reconcile.reservation_utilisation(line_items, line_items).collect()
    assert len(got) == 1
    assert got[0].reservation_id == "ri-orchid"
    assert (got[0].used_hours, got[0].fee_hours) == (3, 120)
    assert (got[0].used_cost, got[0].fee) == (Decimal("0.90"), Decimal("36"))
    assert got[0].unused_cost == Decimal("35.10")


def test_unused_and_unpaid_reservations_are_kept(line_items):
    fees = line_items.filter("line_item_type = 'RIFee'")
    other = fees.withColumn("reservation_arn", F.lit("arn/ri-other"))
    got = _by(reconcile.reservation_utilisation(line_items, other), "reservation_id")
    assert got["ri-other"].utilisation == 0 and got["ri-orchid"].fee is None


def test_non_base_currency_counts_missing(spark):
    df = spark.createDataFrame([("USD",), ("EUR",), (None,)], "c string")
    assert [r[0] for r in df.select(costs.not_in_base(F.col("c"))).collect()] == [False, True, True]


def test_credit_types(billing_rows):
    got = _by(normalize.credit_types(billing_rows), "credit_type")
    assert {k: (r.credits, r.amount) for k, r in got.items()} == {
        "COMMITTED_USAGE_DISCOUNT": (3, Decimal("-2.10")),
        "SUSTAINED_USAGE_DISCOUNT": (1, Decimal("-0.45")),
        "FREE_TIER": (2, Decimal("-0.85")),
    }
    assert billing_rows.filter(F.size("credits") == 0).count() == 4


def test_spend_by_hour_and_day(line_items, billing_rows):
    both = normalize.canonical(line_items, billing_rows)
    hours = normalize.spend_by(both.filter("team = 'orchid'"), ["provider"], "hour")
    got = {(r.provider, r.hour.hour): r.effective_cost for r in hours.collect()}
    assert got == {(p, h): Decimal(c) for p, c in (("AWS", "0.30"), ("GCP", "1.30")) for h in (1, 2, 3)}
    days = normalize.spend_by(both, ["provider"], "day").collect()
    assert {r.day.day for r in days} == {1, 5}


def test_usage_window(line_items):
    rows = _by(normalize.usage_window(line_items), "line_item_id")
    assert rows["res-1"].window_seconds == 3600
    assert rows["fee"].window_seconds == 31 * 24 * 3600
    bad = normalize.usage_window(line_items.limit(1).withColumn("time_interval", F.lit("x"))).first()
    assert bad.window_start is None and bad.window_end is None and bad.window_seconds is None


def test_resource_names(spark):
    df = spark.createDataFrame([("projects/p-1/regions/eu/commitments/cud-0123", "arn/x:reserved-instances/ri-9"), ("odd", "odd")], "n string, a string")
    c = F.col
    got = df.select(text.commitment_id(c("n")), text.commitment_project(c("n")), text.reservation_id(c("a"))).collect()
    assert tuple(got[0]) == ("cud-0123", "p-1", "ri-9")


def test_token_table(spark):
    tokens = [None, "", "  ", "5", " 5 ", "\t5\n", "+5", "12", "13", "-1", "5.5", "junk", "99999999999", "9" * 30]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t string")
    got = df.select("i", text.decode_token(F.col("t"), F.lit(12)).alias("o")).orderBy("i").collect()
    assert [r.o for r in got] == [0, 0, 0, 5, 5, 5, 5, 12, 0, 0, 0, 0, 0, 0]


def test_content_id_separates_parts_and_nulls(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("", None), (None, "")], "x string, y string")
    assert df.select(text.content_id(F.col("x"), F.col("y"))).distinct().count() == 4


@given(
    st.lists(
        st.one_of(
            st.text(alphabet=" \t+-.0123456789ax", max_size=12),
            st.integers(-20, 40).map(str),
            st.none(),
        ),
        min_size=200,
        max_size=200,
    ),
    st.integers(0, 30),
)
@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
def test_tokens_against_a_plain_parser(spark, tokens, size):
    def parse(token):
        text = (token or "").strip(" \t")
        if not re.fullmatch(r"[+-]?[0-9]+", text):
            return 0
        return int(text) if 0 <= int(text) <= size else 0

    df = spark.createDataFrame(list(enumerate(tokens)), "i int, t string")
    got = df.select("i", text.decode_token(F.col("t"), F.lit(size)).alias("o")).collect()
    assert {r.i: r.o for r in got} == {i: parse(t) for i, t in enumerate(tokens)}


def test_parts_sum_to_the_whole(spark):
    start = datetime(2025, 3, 1, 22, 30)
    rows = [
        (1, start, start + timedelta(hours=3), "10.000001", "-0.000002"),
        (2, start, start + timedelta(days=3, seconds=1), "-7.000003", None),
        (3, start, start, "5.5", "1"), (4, start, None, "2", "3"), (5, None, start, "1.25", "0"),
        (6, datetime(2025, 3, 2), datetime(2025, 3, 3), "0.000001", "999999999999.999999"),
    ]
    kind = "id int, usage_start timestamp, usage_end timestamp, a decimal(18,6), b decimal(18,6), place string"
    df = spark.createDataFrame([(*r[:3], *(x and Decimal(x) for x in r[3:]), "kept") for r in rows], kind)
    for grain, length in (("hour", 3600), ("day", 86400)):
        parts = normalize.apportioned(df, ["a", "b"], grain).collect()
        for number, begins, ends, *amounts in rows:
            mine = sorted((p for p in parts if p["id"] == number), key=lambda p: (p["part_start"] is not None, p["part_start"]))
            for name, amount in zip("ab", amounts):
                held = [p[name] for p in mine]
                assert held == [None] * len(mine) if amount is None else sum(held) == Decimal(amount)
            if begins and ends and ends > begins:
                first = begins.replace(minute=0, hour=0 if grain == "day" else begins.hour)
                spans = [first + timedelta(seconds=length * k) for k in range(len(mine))]
                assert [p["part_start"] for p in mine] == spans and spans[-1] < ends <= spans[-1] + timedelta(seconds=length)
                for p in mine:
                    begin, end = max(begins, p["part_start"]), min(ends, p["part_start"] + timedelta(seconds=length))
                    exact = Decimal(amounts[0]) * int((end - begin).total_seconds()) / int((ends - begins).total_seconds())
                    assert abs(p["a"] - exact) < Decimal("0.000001")
            else:
                assert len(mine) == 1 and mine[0]["place"] == "kept"


@pytest.mark.parametrize("hot_rows", [10**9, 2])
def test_fees_meet_usage_by_period(spark, hot_rows):
    day = lambda n: f"2025-01-{n:02d}T00:00:00Z"
    usage = [("r1", "u1", day(1), day(3), "48", "4.8"), ("r1", "u2", day(9), day(12), "72", "1.000001"),
             ("r2", "u3", day(1), day(2), "24", "2"), ("r1", "u4", day(5), day(5), "1", "1"), (None, "u5", day(1), day(2), "1", "1"),
             ("r1", "u6", day(20), day(21), "24", "9")]
    fees = [("r1", "f1", day(1), day(10), "216", "50"), ("r1", "f2", day(10), day(15), "120", "20"), ("r1", "f3", day(2), day(11), "216", "7"),
            ("r3", "f4", day(1), day(9), "10", "1"), ("r2", "f5", day(1), day(1), "0", "1")]
    one = spark.createDataFrame(
        [(a, i, s, e, Decimal(h), Decimal(c), "DiscountedUsage") for a, i, s, e, h, c in usage],
        "reservation_arn string, line_item_id string, usage_start string, usage_end string, usage_amount decimal(24,6), reservation_effective_cost decimal(18,6), line_item_type string",
    )
    two = spark.createDataFrame(
        [(a, i, s, e, Decimal(h), Decimal(c), "RIFee") for a, i, s, e, h, c in fees],
        "reservation_arn string, line_item_id string, usage_start string, usage_end string, usage_amount decimal(24,6), unblended_cost decimal(18,6), line_item_type string",
    )
    got = {r["fee_id"]: (r["usage_rows"], r["used_hours"], r["used_cost"]) for r in reconcile.reservation_by_period(one, two, hot_rows).collect()}
    third = Decimal("0.333333")
    assert got == {
        "f1": (2, 72, Decimal("4.8") + third), "f2": (1, 48, Decimal("1.000001") - third),
        "f3": (2, 72, Decimal("2.4") + Decimal("0.666667")), "f4": (0, 0, 0), "f5": (0, 0, 0),
    }


def _periods(spark, fees_of):
    """Daily usage of three reservations over a year, and fees whose periods of five years begin a day after another."""
    usage = spark.range(3 * 365).select(
        F.concat(F.lit("r"), (F.col("id") % 3).cast("string")).alias("reservation_arn"), F.col("id").cast("string").alias("line_item_id"),
        *(F.date_format(F.timestamp_seconds(1735689600 + F.col("id") * 28800 + more), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(name)
          for name, more in (("usage_start", 0), ("usage_end", 7 * 86400))),
        F.lit(2).cast("decimal(24,6)").alias("usage_amount"), F.lit(1).cast("decimal(18,6)").alias("reservation_effective_cost"),
        F.lit("DiscountedUsage").alias("line_item_type"),
    )
    fees = spark.range(3 * fees_of).select(
        F.concat(F.lit("r"), (F.col("id") % 3).cast("string")).alias("reservation_arn"), F.concat(F.lit("f"), F.col("id")).alias("line_item_id"),
        *(F.date_format(F.timestamp_seconds(1738368000 + F.col("id") * 86400 + more), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(name)
          for name, more in (("usage_start", 0), ("usage_end", 5 * 365 * 86400))),
        F.lit(2).cast("decimal(24,6)").alias("usage_amount"), F.lit(1).cast("decimal(18,6)").alias("unblended_cost"),
        F.lit("RIFee").alias("line_item_type"),
    )
    return usage, fees


@pytest.mark.parametrize("fees_of", [2, 40])
def test_periods_are_not_copied_into_a_broadcast(spark, fees_of):
    by_period = reconcile.reservation_by_period(*_periods(spark, fees_of))
    assert by_period.filter("usage_rows > 200").count() == 3 * fees_of
    plan = by_period._jdf.queryExecution().optimizedPlan().toString()
    assert ("explode(sequence(" in plan) == (fees_of == 40)  # more than reconcile.FEW_PERIODS
    joins = by_period._jdf.queryExecution().sparkPlan().toString()
    assert not re.search(r"BroadcastHashJoin \[[^]]*_bucket", joins)


def test_periods_meet_alike_however_many_they_are(spark):
    shown = lambda *how: sorted(map(tuple, reconcile.reservation_by_period(*_periods(spark, 3), *how).collect()), key=str)
    wanted = shown(10**9, 10**9)
    assert shown(10**9, 2) == shown(100, 2) == shown(100, 10**9) == wanted


def test_restated_spend_follows_deliveries(spark, tmp_path):
    at = datetime(2025, 3, 1, 5)
    rows = [(f"a{k % 3}", at + timedelta(days=k % 4), Decimal(k), Decimal("1.5")) for k in range(40)]
    schema = "account string, usage_start timestamp, net_cost decimal(18,6), rate decimal(10,6)"
    frame = lambda x: spark.createDataFrame(x, schema).withColumns({n: F.col("net_cost") for n in ("list_cost", "effective_cost")})
    path = str(tmp_path / "spend")
    restate.take_in(path, "one", None, frame(rows), ["account"])
    changed = [(*r[:2], r[2] + 1, r[3]) for r in rows[:9]]
    for _ in range(2):
        restate.take_in(path, "two", frame(rows[:10]), frame(changed), ["account"])  # the tenth row is withdrawn
    whole = normalize.spend_by(frame(changed + rows[10:]), ["account"], "day")
    names = ["account", "day", "line_count", "net_cost", "list_cost"]
    shown = lambda df: sorted(map(tuple, df.select(*names).collect()))
    assert shown(restate.spend(spark, path, ["account"])) == shown(whole)
    last = frame(changed + rows[10:])
    restate.take_in(path, "three", last, last.limit(0), ["account"])
    assert restate.spend(spark, path, ["account"]).isEmpty()
    assert restate.deltas(last, last, ["account"]).isEmpty()
