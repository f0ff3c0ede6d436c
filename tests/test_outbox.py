from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.functions import costs
from tallybook.operators import expectations, outbox, reconcile
from tallybook.sources import eventlog
from tallybook.streaming import streams, units

T0 = datetime(2025, 11, 17, 10)


def events(spark, *rows):
    """Rows of (id, aggregate type, aggregate id, type, payload, seconds after T0)."""
    data = [(*r[:5], T0 + timedelta(seconds=r[5])) for r in rows]
    return spark.createDataFrame(data, schemas.OUTBOX)


@pytest.fixture
def sample(spark):
    return events(
        spark,
        ("e1", "page", "desk-1", "PageLanded", '{"badge": 31}', 0),
        ("e2", "pledge", "desk-2", "PledgeNoted", '{"badge": 32}', 1),
        ("e3", "page", "hall", "PageLanded", '{"origin":"o","lots":[{"code":"a","sizes":[1,2]}]}', 2),
        ("e4", "shift", "unit-4", "ShiftAsked", '{"count":4}', 3),
        ("e6", "shift", "unit-4", "ShiftAsked", "{}", 3),
        ("e5", "shift", "unit-4", "ShiftAsked", "{}", 3),
    )


def test_routing_by_family_with_key_and_headers(sample):
    log = outbox.route(sample, "x.events")
    got = {costs_id: topic for costs_id, topic in log.select(costs.tag(F.col("headers"), "id"), "topic").collect()}
    assert got["e1"] == "x.events.page" and got["e2"] == "x.events.pledge"
    row = log.filter("topic = 'x.events.pledge'").first()
    assert (row.key, row.value) == ("desk-2", '{"badge": 32}')
    assert [(h.key, h.value) for h in row.headers] == [("id", "e2"), ("type", "PledgeNoted")]
    assert log.filter("topic = 'x.events.page'").filter(F.col("value").contains("desk-2")).isEmpty()


def test_leakage(sample):
    log = sample.select("id", F.concat(F.lit("t."), "aggregate_type").alias("topic"))
    assert outbox.topic_leakage(log).isEmpty()
    leaked = log.unionByName(log.filter("id = 'e2'").withColumn("topic", F.lit("t.page")))
    assert [r.id for r in outbox.topic_leakage(leaked).collect()] == ["e2"]


def test_order_within_aggregate_breaks_ties_by_id(sample):
    got = outbox.ordered(sample).filter("aggregate_id = 'unit-4'").orderBy("sequence").collect()
    assert [(r.id, r.sequence) for r in got] == [("e4", 1), ("e5", 2), ("e6", 3)]


def test_nested_payload_by_schema_and_by_path(sample):
    body = outbox.expand(sample, "origin string, lots array<struct<code:string,sizes:array<int>>>")
    row = body.filter("id = 'e3'").first()
    assert row["lots"][0].sizes == [1, 2]
    paths = sample.select("id", outbox.payload_field("payload", "$.lots[0].code", "string").alias("v"))
    assert {r.id: r.v for r in paths.collect()}["e3"] == "a"


def test_capture_takes_listed_tables_without_updates_and_deletes(spark, sample):
    named = sample.withColumns({"source_schema": F.lit("ingestion"), "source_table": F.lit("outbox_event")})
    late = named.filter("id IN ('e2', 'e3')").withColumn("op", F.lit("c"))
    removed = named.filter("id = 'e1'").withColumn("op", F.lit("d"))
    update = named.filter("id = 'e4'").withColumn("op", F.lit("u"))
    foreign = named.filter("id = 'e5'").withColumns({"op": F.lit("c"), "source_schema": F.lit("public")})
    changes = late.unionByName(removed).unionByName(update).unionByName(foreign)
    got = outbox.capture(named.filter("id IN ('e1', 'e2')"), changes, ["ingestion.outbox_event"]).collect()
    assert {r.id: r.op for r in got} == {"e1": "r", "e2": "r", "e3": "c"}


def test_replayable_ids_and_stamped_ids(spark):
    state = spark.createDataFrame([("unit-4", 10, T0), ("unit-5", 10, T0)], "k string, count int, at timestamp")
    build = lambda **more: outbox.to_events(
        state, F.lit("shift"), F.col("k"), F.lit("ShiftAsked"), ["count"], **more
    )
    first = {r.id for r in build(created_at=F.col("at")).collect()}
    assert len(first) == 2 and first == {r.id for r in build(created_at=F.col("at")).collect()}
    stamped = build(replayable=False)
    assert stamped.schema.fieldNames() == schemas.OUTBOX.fieldNames()
    rows = stamped.collect()
    assert len({r.id for r in rows} - first) == 2 and all(r.created_at for r in rows)
    assert rows[0].payload == '{"count":10}'
    with pytest.raises(ValueError, match="created_at"):
        build()


def test_latest_cursor_replaces_the_saved_one(spark):
    old = spark.createDataFrame([("feed-7", "mark-8", T0), ("other", None, T0)], schemas.CURSOR)
    new = spark.createDataFrame([("feed-7", "mark-9", T0 + timedelta(1)), ("new", "t", T0)], schemas.CURSOR)
    got = {r.source: r.last_token for r in outbox.upsert_cursor(old, new).collect()}
    assert got == {"feed-7": "mark-9", "other": None, "new": "t"}
    keys = spark.createDataFrame([("feed-7",), ("none",)], "source string")
    assert [r.last_token for r in reconcile.lookup(old, keys, ["source"]).collect()] == ["mark-8"]


def test_seen_events_are_dropped(sample):
    got = reconcile.drop_seen(sample, sample.filter("aggregate_type = 'shift'"), ["id"])
    assert {r.id for r in got.collect()} == {"e1", "e2", "e3"}


def test_copies_of_seen_ids_all_go_and_null_ids_all_stay(spark, sample):
    copies = sample.crossJoin(spark.range(5).select()).unionByName(
        sample.limit(4).withColumn("id", F.lit(None).cast("string"))
    )
    seen = copies.filter("id IN ('e1', 'e2') OR id IS NULL")
    got = reconcile.drop_seen(copies, seen, ["id"]).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in got} == {"e3": 5, "e4": 5, "e5": 5, "e6": 5, None: 4}


def test_retention_reads_only_days_to_keep(spark, sample, tmp_path):
    old = sample.withColumn("created_at", F.col("created_at") - F.expr("INTERVAL 8 DAYS"))
    path = str(tmp_path / "all")
    outbox.write_by_date(sample.unionByName(old.withColumn("id", F.concat("id", F.lit("-old")))), path)
    cutoff = T0 + timedelta(seconds=1)
    kept = outbox.retained(spark, path, cutoff)
    assert {r.id for r in kept.collect()} == {"e2", "e3", "e4", "e5", "e6"}
    assert "PartitionFilters: [isnotnull(created_date" in kept._jdf.queryExecution().toString()
    day = str((T0 - timedelta(8)).date())
    assert outbox.expired_days(spark, path, cutoff) == [day]
    assert outbox.drop_expired(spark, path, cutoff) == [day]
    left = spark.read.parquet(path)
    assert {r.id for r in left.collect()} == {"e2", "e3", "e4", "e5", "e6"} and left.count() == 5
    assert outbox.drop_expired(spark, path, cutoff) == [] and spark.read.parquet(path).count() == 5


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (("payload", "'{\"broken\"'"), "malformed payload"),
        (("type", "repeat('x', 256)"), "too long"),
        (("aggregate_id", "CAST(NULL AS STRING)"), "missing value"),
        (("id", "substring(id, 2)"), "duplicate id"),
        (("id", "'same'"), "duplicate id"),
    ],
)
def test_a_bad_event_fails_the_unit_and_leaves_no_rows(spark, sample, tmp_path, change, message):
    path = str(tmp_path / "box")
    state = sample.select("aggregate_id")
    units.append(state, sample, 0, path)
    more = sample.withColumn("id", F.concat(F.lit("n"), "id"))
    with pytest.raises(Exception, match=message):
        units.append(state, more.withColumn(change[0], F.expr(change[1])), 1, path)
    counts = lambda: [units.appended(spark, path, name).count() for name in ("state", "events")]
    assert counts() == [6, 6]
    for _ in range(2):  # a batch that is run again replaces itself
        units.append(state, more, 1, path)
        assert counts() == [12, 12]


def test_append_outside_a_batch_is_rejected(spark, sample, tmp_path):
    with pytest.raises(units.NoBatchError):
        units.append(sample, sample, None, str(tmp_path / "box"))
    assert not (tmp_path / "box").exists()


def test_cursor_ties_and_limits(spark):
    cursor = lambda *rows: spark.createDataFrame([(s, t, T0 + timedelta(d)) for s, t, d in rows], schemas.CURSOR)
    after = lambda old, new: {r.source: r.last_token for r in outbox.upsert_cursor(old, new).collect()}
    assert after(cursor(("a", "9", 0)), cursor(("a", "10", 0))) == {"a": "10"}
    assert after(cursor(("a", "10", 0)), cursor(("a", "9", 0))) == {"a": "9"}
    assert after(cursor(("a", "7", 1)), cursor(("a", "8", 0), ("b", "9", 0), ("b", "10", 0))) == {"a": "7", "b": "10"}
    for bad in (cursor(("s" * 65, "1", 0)), cursor(("s", "t" * 256, 0))):
        with pytest.raises(Exception, match="too long in cursor"):
            outbox.upsert_cursor(cursor(("a", "1", 0)), bad).collect()


def test_quarantine_keeps_bad_syntax_and_bad_types(spark):
    df = spark.createDataFrame([("a", '{"k": 1}'), ("b", '{"k": '), ("c", '{"k": "x"}'), ("d", "{}"), ("e", None)], "id string, payload string")
    good, bad = streams.quarantine(df, schemas.T.StructType.fromDDL("k long"))
    assert {r.id: r.k for r in good.collect()} == {"a": 1, "d": None}
    assert {r.id: r.payload for r in bad.collect()} == {"b": '{"k": ', "c": '{"k": "x"}', "e": None}
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        streams.parse_strictly(df, schemas.T.StructType.fromDDL("k long")).collect()


def test_checks_report_violations(line_items):
    every, some = expectations.value_set("line_item_type", costs.AWS_CHARGE_CLASS)
    every |= {"no_tax": F.col("line_item_type") != "Tax", "team": F.col("tag_team").isNotNull()}
    got = {r.check_name: r.violations for r in expectations.check(line_items, every, some, {"rows": 13}).collect()}
    assert got.pop("no_tax") == 2 and got.pop("team") == 4
    assert set(got.values()) == {0} and len(got) == 8
    assert expectations.check(line_items, row_count={"rows": 10}).first().violations == 3
    assert expectations.unique(line_items, "id", ["line_item_id"]).first().passed
    twice = line_items.unionByName(line_items.limit(1))
    assert expectations.unique(twice, "id", ["line_item_id"]).first().violations == 1


def test_table_rules_cover_null_and_length(spark):
    rules = expectations.table_rules(schemas.CURSOR, schemas.CURSOR_MAX_LENGTH)
    rows = [("s" * 65, None, T0), ("s", "t" * 256, None)]
    kind = schemas.T.StructType([schemas.T.StructField(f.name, f.dataType) for f in schemas.CURSOR])
    got = {r.check_name: r.violations for r in expectations.check(spark.createDataFrame(rows, kind), rules).collect()}
    assert got == {"source_present": 0, "updated_at_present": 1, "source_fits": 1, "last_token_fits": 1}


def test_topic_catalogue_has_a_settable_prefix():
    assert schemas.topics("acme")["raw_aws"] == "acme.billing.raw.aws"
    assert schemas.topics("acme")["canonical_cost"] == "acme.cost.canonical"


def test_event_log_round_trip_in_batch(spark, sample, tmp_path):
    conf = eventlog.LogConfig("files", str(tmp_path / "log"))
    eventlog.write_log(outbox.route(sample, "x"), conf)
    only = eventlog.LogConfig("files", conf.path, topics=("x.page",))
    rows = eventlog.read_log(spark, only, streaming=False).collect()
    assert {(r.topic, r.key) for r in rows} == {("x.page", "desk-1"), ("x.page", "hall")}
    assert rows[0].timestamp.microsecond == 0 and rows[0].headers[0].key == "id"
    with pytest.raises(ValueError, match="unknown log format"):
        eventlog.read_log(spark, eventlog.LogConfig("paper"))
