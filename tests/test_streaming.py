import json
import os
import random
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.operators import outbox, reconcile
from tallybook.plans import queries
from tallybook.sources import adapters, eventlog
from tallybook.streaming import ledger, sinks, standing, streams
from tallybook.streaming.standing import ON_DISK, with_standing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The events in four files, cut by time and written in order."""
    path = str(tmp_path_factory.mktemp("events") / "rows")
    events = adapters.table(spark, SF, "events")
    for part in range(4):
        events.filter(F.floor(F.col("event_id") / 250) == part).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path, files=1):
    return spark.readStream.schema(adapters.EVENTS).option("maxFilesPerTrigger", files).parquet(path)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def paths(tmp_path, name="out"):
    return str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")


def test_ingest_resumes_and_replays(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    c = F.col
    run = lambda to, ck: streams.ingest(
        stream(spark, landed), to, ck, c("event_type"), c("event_id"), c("ts").cast("timestamp")
    )
    events = adapters.table(spark, SF, "events")
    expected = events.groupBy("event_type").agg(F.max("event_id").cast("string"))
    assert streams.read_cursor(spark, path).collect() == []
    for _ in range(2):
        run(path, checkpoint)
        got = sinks.written(spark, f"{path}/rows")
        assert rows(got, "event_id") == rows(events, "event_id") and got.agg(F.max("batch_id")).first()[0] == 3
    assert rows(streams.read_cursor(spark, path), "source", "last_token") == rows(expected, "*")
    assert len(list(Path(f"{path}/cursor").glob("batch_id=*"))) == 2  # that of the last batch, and the one before
    with pytest.raises(ValueError, match="a replay needs a folder of its own"):
        run(path, checkpoint + "-fresh")
    run(path + "-again", checkpoint + "-fresh")
    assert rows(sinks.written(spark, f"{path}-again/rows"), "event_id") == rows(events, "event_id")


def test_a_cursor_never_runs_ahead_of_its_page(spark, landed, tmp_path, monkeypatch):
    path, checkpoint = paths(tmp_path)
    c = F.col
    run = lambda: streams.ingest(
        stream(spark, landed), path, checkpoint, c("event_type"), c("event_id"), c("ts").cast("timestamp")
    )
    real, crash = streams.carry, {"at": 2}

    def carry(df, to, batch_id):
        if batch_id == crash["at"]:
            raise RuntimeError("lost before the cursor")
        real(df, to, batch_id)

    monkeypatch.setattr(streams, "carry", carry)
    with pytest.raises(Exception, match="lost before the cursor"):
        run()
    tops = lambda df: sorted(df.groupBy("event_type").agg(F.max("event_id").cast("string")).collect())
    landed_rows = sinks.written(spark, f"{path}/rows")
    assert sorted(rows(streams.read_cursor(spark, path), "source", "last_token")) == [tuple(r) for r in tops(landed_rows.filter("batch_id < 2"))]
    crash["at"] = None
    run()
    landed_rows = sinks.written(spark, f"{path}/rows")
    assert landed_rows.count() == 1000
    assert sorted(rows(streams.read_cursor(spark, path), "source", "last_token")) == [tuple(r) for r in tops(landed_rows)]


def units(df):
    return adapters.outbox_of(df, F.struct("user_id", "event_id").alias("state"))


def test_both_outputs_of_a_batch_or_neither_through_two_kills(spark, landed, tmp_path):
    """A query that is stopped between batches goes on from its checkpoint; readers see whole batches at any time."""
    path, checkpoint = paths(tmp_path)
    for batches in (1, 2):
        query = (
            tagged_writer(units(stream(spark, landed)), path, checkpoint).trigger(processingTime="0 seconds").start()
        )
        while not query.recentProgress or query.lastProgress["batchId"] < batches:
            query.processAllAvailable() if batches > 5 else None
        query.stop()
        seen = {name: streams.appended(spark, path, name).count() for name in ("state", "events")}
        assert seen["state"] == seen["events"] and seen["state"] % 250 == 0 and seen["state"] >= 250
    streams.append_units(units(stream(spark, landed)), path, checkpoint)
    events = streams.appended(spark, path, "events")
    assert (events.count(), events.select("id").distinct().count()) == (1000, 1000)
    assert rows(streams.appended(spark, path, "state"), "event_id") == rows(adapters.table(spark, SF, "events"), "event_id")


def tagged_writer(df, path, checkpoint):
    """The writer that ``append_units`` runs to the end, to be run and stopped at will."""
    held = {}

    def keep(tagged, to, ck, partition_by, *_, **__):
        writer = tagged.writeStream.format("parquet").option("path", to).option("checkpointLocation", ck)
        held["writer"] = writer.partitionBy(*partition_by)

    patch = pytest.MonkeyPatch()
    patch.setattr(streams, "write_rows", keep)
    streams.append_units(df, path, checkpoint)
    patch.undo()
    return held["writer"]


def test_a_bad_event_fails_its_batch_and_shows_nothing_of_it(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    bad = units(stream(spark, landed)).withColumn("payload", F.when(F.col("id") == 600, '{"cut').otherwise(F.col("payload")))
    with pytest.raises(Exception, match="malformed payload in outbox event 600"):
        streams.append_units(bad, path, checkpoint)
    for name in ("state", "events"):
        assert streams.appended(spark, path, name).count() == 500
    streams.append_units(units(stream(spark, landed)), path, checkpoint)
    assert streams.appended(spark, path, "events").count() == 1000


def test_an_id_appended_before_is_left_out_with_its_state(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    again = units(stream(spark, landed)).withColumn("id", F.when(F.col("id") == 990, "10").otherwise(F.col("id")))
    for _ in range(2):  # a restart has not forgotten it
        with pytest.raises(sinks.RepeatedRowsError, match="^1 rows had an id"):
            streams.append_units(again, path, checkpoint)
    assert streams.appended(spark, path, "events").filter("id = '10'").count() == 1
    assert streams.appended(spark, path, "events").count() == streams.appended(spark, path, "state").count() == 999
    assert streams.appended(spark, path, "state").filter("event_id = 990").isEmpty()


def test_each_batch_keeps_its_own_state(spark, tmp_path):
    """A user's state of an earlier batch stays beside that of a later one, and each row tells its batch."""
    path, checkpoint = paths(tmp_path)
    events = adapters.table(spark, SF, "events").withColumn("batch_id", F.floor(F.col("event_id") / 250))
    stream = adapters.landed_stream(spark, events, F.col("batch_id"), 4)
    state = F.struct("user_id", "event_id").alias("state")
    streams.append_units(adapters.outbox_of(stream, state, F.col("batch_id")), path, checkpoint)
    got = streams.appended(spark, path, "state")
    assert rows(got, "event_id", "user_id", "batch_id") == rows(events, "event_id", "user_id", "batch_id")
    got = streams.appended(spark, path, "events")
    assert rows(got, "id", "batch_id") == rows(events, F.col("event_id").cast("string"), "batch_id")
    # the sink's own log: the files of a batch hold that delivery and no other
    for n in range(4):
        log = [json.loads(x) for x in Path(f"{path}/_spark_metadata/{n}").read_text().splitlines()[1:]]
        held = spark.read.option("basePath", path).parquet(*[x["path"] for x in log])
        assert rows(held.select("batch_id", "output").distinct(), "*") == [(n, "events"), (n, "state")]
    by_batch = queries.stream_outbox_commit(spark, SF).filter("output = 'state'").groupBy("key").count()
    assert by_batch.agg(F.max("count")).first()[0] == 4


def test_a_replay_cut_differently_goes_to_its_own_folder(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    sinks.write_rows(stream(spark, landed), path, checkpoint)
    with pytest.raises(ValueError, match="a replay needs a folder of its own"):
        sinks.write_rows(stream(spark, landed, 4), path, f"{checkpoint}-2")
    sinks.write_rows(stream(spark, landed, 4), f"{path}-2", f"{checkpoint}-2")
    for folder in (path, f"{path}-2"):
        assert rows(sinks.written(spark, folder), "event_id") == rows(adapters.table(spark, SF, "events"), "event_id")


def test_readers_change_over_to_a_replay_once_it_is_through(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    every = rows(adapters.table(spark, SF, "events"), "event_id")
    with pytest.raises(ValueError, match="no run of .* is through"):
        sinks.current(spark, path)
    sinks.write_run(stream(spark, landed), path, "first", checkpoint)
    assert rows(sinks.current(spark, path), "event_id") == every
    stops = F.when(F.col("event_id") == 990, F.raise_error(F.lit("stopped on its way"))).otherwise(F.col("props"))
    with pytest.raises(Exception, match="stopped on its way"):
        sinks.write_run(stream(spark, landed).withColumn("props", stops.cast("string")), path, "again", f"{checkpoint}-2")
    assert sinks.written(spark, f"{path}/again").count() == 750  # three batches of the replay are there
    assert rows(sinks.current(spark, path), "event_id") == every and sinks.current(spark, path).filter("props = 'new'").isEmpty()
    changed = stream(spark, landed).withColumn("props", F.lit("new"))
    sinks.write_run(changed, path, "again", f"{checkpoint}-2")
    assert rows(sinks.current(spark, path), "event_id") == every
    assert sinks.current(spark, path).filter("props = 'new'").count() == 250
    sinks.write_run(stream(spark, landed), path, "first", checkpoint)  # goes on, with nothing new
    assert sinks.current(spark, path).filter("props = 'new'").count() == 250


def test_the_replayed_log_has_each_event_once(spark):
    events = adapters.table(spark, SF, "events")
    got = queries.stream_replay(spark, SF)
    assert got.columns == events.columns and rows(got, "*") == rows(events, "*")


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_batch(spark.range(3), path, 0)
    sinks.write_batch(spark.range(9), path, 1)
    sinks.write_batch(spark.range(5, 7), path, 1)
    assert rows(sinks.written(spark, path), "id", "batch_id") == [(0, 0), (1, 0), (2, 0), (5, 1), (6, 1)]
    for n in range(4):
        sinks.carry(spark.range(n, n + 1), f"{path}-last", n)
    kind = spark.range(1).schema
    assert [r.id for r in sinks.carried(spark, f"{path}-last", kind).collect()] == [3]
    assert [r.id for r in sinks.carried(spark, f"{path}-last", kind, 3).collect()] == [2]
    assert sinks.carried(spark, f"{path}-none", kind).collect() == []


def test_stream_dedup_equals_batch(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    twice = adapters.outbox_of(stream(spark, landed)).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("_n")
    found = sinks.write_rows(streams.dedup(twice, "id", "created_at", "2 days"), path, checkpoint)
    assert rows(sinks.written(spark, path), "id") == rows(adapters.outbox_like(spark, SF), "id")
    assert found == {ledger.REPEATED: 2000}


@pytest.fixture(scope="module")
def backwards(spark):
    """The events in four files, the newest first."""
    events = adapters.table(spark, SF, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path = adapters.land(events, F.floor(F.col("event_id") / 250), 4, newest_first=True)
    return lambda: adapters.stream_of(spark, path, events.schema)


def test_exact_dedup_loses_no_first_copy(spark, backwards, tmp_path):
    path, checkpoint = paths(tmp_path)
    named = backwards().withColumn("event_id", F.when(F.col("event_id") % 10 > 0, F.col("event_id")))
    sinks.write_rows(streams.dedup_exact(named, "event_id"), path, checkpoint)
    assert sinks.written(spark, path).count() == 1000  # a hundred of them without an id


def test_late_rows_fail_a_run_or_are_put_aside(spark, backwards, tmp_path):
    path, checkpoint = paths(tmp_path)
    for _ in range(2):
        with pytest.raises(sinks.LateRowsError, match=r"^\d+ rows came later"):
            sinks.write_rows(streams.dedup(backwards(), "event_id", "ts", "1 day"), path, checkpoint)
    path, checkpoint = paths(tmp_path, "split")
    streams.split_late(backwards(), "ts", "1 DAY", path, checkpoint)
    parts = [rows(streams.split_rows(spark, path, name), "event_id") for name in ("rows", "late")]
    assert sorted(parts[0] + parts[1], key=str) == rows(adapters.table(spark, SF, "events"), "event_id")
    assert len(parts[1]) > 400


def monkeypatch_progress(spark, request, batches):
    setting = "spark.sql.streaming.numRecentProgressUpdates"
    held = spark.conf.get(setting)
    spark.conf.set(setting, batches)
    request.addfinalizer(lambda: spark.conf.set(setting, held))


def test_a_late_row_of_the_first_batches_is_not_forgotten(spark, tmp_path, request):
    """Spark keeps the progress of some batches only, here three, and of none before a restart; the row comes in batch 2."""
    monkeypatch_progress(spark, request, 3)
    start = datetime(2025, 1, 1)
    data = [(k, start + timedelta(hours=k)) for k in range(12)]
    data[2] = (2, start - timedelta(days=3))
    feed = spark.createDataFrame(data, "id long, ts timestamp").repartitionByRange(12, "id")
    source = str(tmp_path / "feed")
    feed.write.parquet(source)
    for k, file in enumerate(sorted(Path(source).glob("part-*"))):  # a stream takes files by their time
        os.utime(file, (1e9 + k, 1e9 + k))
    timed = lambda files, delay: (
        spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", files).parquet(source)
        .withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id"])
    )
    good, bad = paths(tmp_path, "good"), paths(tmp_path, "bad")
    sinks.write_rows(timed(6, "30 days"), *good, state_partitions=1)
    for _ in range(2):
        with pytest.raises(sinks.LateRowsError, match="^1 rows came later"):
            sinks.write_rows(timed(1, "1 hour"), *bad, state_partitions=1)
    assert sinks.written(spark, good[0]).count() == 12  # what readers have stays whole
    assert ledger.counted(spark, bad[1]) == {ledger.LATE: 1}


def test_observed_checks_fail_a_run(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    clicks = adapters.table(spark, SF, "events").filter("event_type = 'click'").count()
    checks = {"positive": F.col("value") > -1, "no_click": F.col("event_type") != "click"}
    with pytest.raises(sinks.ViolationsError, match=f"^no_click: {clicks} rows$"):
        streams.checked_rows(stream(spark, landed), "rules", checks, path, checkpoint)
    streams.checked_rows(stream(spark, landed), "rules", {"positive": F.col("value") > -1}, *paths(tmp_path, "clean"))
    assert sinks.written(spark, str(tmp_path / "clean")).count() == 1000


def test_resume_goes_on_beyond_each_cursor(spark):
    events = adapters.table(spark, SF, "events")
    cursor = spark.createDataFrame([("view", "900", datetime(2025, 1, 1)), ("click", "99", datetime(2025, 1, 1))], schemas.CURSOR)
    got = streams.beyond_cursor(events, F.col("event_type"), F.col("event_id"), cursor)
    beyond = "(event_type = 'view' AND event_id > 900) OR (event_type = 'click' AND event_id > 99) OR event_type NOT IN ('view', 'click')"
    assert rows(got, "event_id") == rows(events.filter(beyond), "event_id") and got.columns == events.columns


def test_ingest_saves_the_highest_token_where_time_disagrees(spark, tmp_path):
    path, checkpoint = paths(tmp_path)
    feed = spark.createDataFrame([("s", 9, 30), ("s", 10, 10), ("s", 2, 40)], "source string, token long, t long")
    landed = adapters.land(feed, (F.col("t") >= 40).cast("int"), 2, newest_first=True)
    c = F.col
    run = streams.ingest(adapters.stream_of(spark, landed, feed.schema), path, checkpoint, c("source"), c("token"), F.timestamp_seconds("t"))
    assert run is None and [r.last_token for r in streams.read_cursor(spark, path).collect()] == ["10"]


def test_each_key_is_delivered_in_order(spark, tmp_path):
    conf = eventlog.LogConfig("files", str(tmp_path / "log"))
    events = adapters.outbox_like(spark, SF).repartition(7)
    eventlog.write_log(outbox.route(events, "x"), conf)
    for file in Path(conf.path).glob("topic=*/part-*.json"):
        seen = {}
        for line in file.read_text().splitlines():
            entry = json.loads(line)
            at = (entry["timestamp"], next(h["value"] for h in entry["headers"] if h["key"] == "id"))
            assert seen.get(entry["key"], at) <= at
            seen[entry["key"]] = at


@pytest.mark.parametrize("hot_rows", [10**9, 3])
def test_stream_audit_equals_batch_across_batches(spark, landed, tmp_path, hot_rows):
    path, checkpoint = paths(tmp_path)
    arrivals = queries._arrivals(stream(spark, landed))
    names = ("aggregate_id", "created_at", "arrival")
    streams.sequence_audit(arrivals, path, checkpoint, *names, hot_rows)
    batch = reconcile.sequence_audit(queries._arrivals(adapters.table(spark, SF, "events")), *names)
    columns = ["id", "arrival_no", "out_of_order", "gap_ms"]
    written = sinks.written(spark, path)
    got = rows(written, *columns)
    assert got == rows(batch, *columns)
    assert any(r[2] for r in got) and written.agg(F.max("batch_id")).first()[0] == 3


def test_standing_keeps_types_and_counts_over_restarts(spark, tmp_path):
    at = datetime(2025, 11, 17, 1, 2, 3, 456789)
    kind = "k string, n long, d decimal(20,6), t timestamp, a array<struct<x:int>>"
    first = spark.createDataFrame([("a", 2**60 + 1, Decimal("1.000001"), at, [(1,)]), ("a", None, None, None, None), (None, 3, None, at, [])], kind)
    more = spark.createDataFrame([("a", 5, None, at - timedelta(days=1), None), (None, 6, None, at, None)], kind)
    path, checkpoint = paths(tmp_path)
    for part in (first, more):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = adapters.stream_of(spark, str(tmp_path / "in"), first.schema)
        sinks.write_rows(with_standing(stream, ["k"], "t"), path, checkpoint, state_partitions=2, settings=ON_DISK)
    got = sinks.written(spark, path)
    assert rows(got, *first.columns) == rows(first.unionByName(more), *first.columns)
    assert rows(got.filter("n IN (5, 6)"), "n", "_arrived_before", "_newest_before") == [(5, 2, at), (6, 1, at)]
    assert got.filter("_arrived_before = 0 AND _newest_before IS NULL").count() == 3


class _Store:
    """What a cell asks of the state store, and how often."""

    def __init__(self):
        self.parts, self.held, self.asked = None, {}, 0

    def getValueState(self, name, schema):  # noqa: N802
        return SimpleNamespace(exists=lambda: self.parts is not None, get=lambda: self.parts, update=lambda x: setattr(self, "parts", x))

    def getMapState(self, name, key, value):  # noqa: N802
        def get(key):
            self.asked += 1
            return self.held[key]

        return SimpleNamespace(containsKey=self.held.__contains__, getValue=get, updateValue=self.held.__setitem__)


def test_a_cell_of_many_keys_is_held_in_parts(monkeypatch):
    monkeypatch.setattr(standing, "PART_KEYS", 8)
    store, rng, wanted = _Store(), random.Random(3), {}
    for batch in range(12):
        cell = standing._Standing()
        cell.init(store)
        sent = [(f"k{rng.randrange(20 * (batch + 1))}", rng.choice([None, str(rng.randrange(10**6))])) for _ in range(200)]
        frames = [pd.DataFrame({"keys": [k for k, _ in cut], "row": [str(k) for k, _ in cut], "micros": [t for _, t in cut]}) for cut in (sent[:90], sent[90:])]
        got = pd.concat(cell.handleInputRows((1,), iter(frames), None))
        held = [wanted.get(k, (0, None)) for k, _ in sent]
        assert list(got["row"]) == [k for k, _ in sent] and list(got["arrived"]) == [n for n, _ in held]
        assert list(got["newest"]) == [None if t is None else str(t) for _, t in held]
        for k, t in sent:
            n, top = wanted.get(k, (0, None))
            wanted[k] = (n + 1, max((int(x) for x in (t, top) if x is not None), default=None))
    assert len(store.held) == store.parts[0] >= len(wanted) / 8
    store.asked = 0
    list(cell.handleInputRows((1,), iter([pd.DataFrame({"keys": ["k1"] * 3, "row": ["x"] * 3, "micros": [None] * 3})]), None))
    assert store.asked == 1


def test_keys_are_called_up_in_cells(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(standing, "CELLS", 3, raising=False)
    sent = spark.range(400).select(F.col("id").cast("string").alias("k"), F.timestamp_seconds("id").alias("t"))
    for cut in (F.col("t") < "1970-01-01 00:05:00", F.col("t") >= "1970-01-01 00:03:20"):
        sent.filter(cut).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    path, checkpoint = paths(tmp_path)
    stream = with_standing(adapters.stream_of(spark, str(tmp_path / "in"), sent.schema), ["k"], "t")
    told = []
    each = lambda df, batch_id: told.append((df.filter("_arrived_before = 1 AND _newest_before = t").count(), df.count()))
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    for key, value in ON_DISK.items():
        spark.conf.set(key, value)
    try:
        query = query.start()
        query.awaitTermination()
    finally:
        for key in ON_DISK:
            spark.conf.unset(key)
    assert told == [(0, 300), (100, 200)]
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 4 * 3  # of a cell: its parts, one part, and what Spark adds to them


def test_windows_in_update_mode_equal_batch(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    value = F.col("value").cast(schemas.MONEY)
    timed = lambda df: df.withColumn("ts", F.col("ts").cast("timestamp"))
    build = lambda df: streams.windowed_spend(timed(df), "ts", value, ["event_type"], "1 day", "1 hour")
    windows = build(stream(spark, landed))
    streams.keep_windows(windows, ["event_type"], path, checkpoint)
    got = streams.current_windows(spark, path, windows.schema)
    batch = build(adapters.table(spark, SF, "events"))
    assert got.count() == got.select("window_start", "event_type").distinct().count() == batch.count()
    assert rows(got, "window_start", "event_type", "row_count", "total") == rows(
        batch, "window_start", "event_type", "row_count", "total"
    )


def test_a_batch_touches_its_own_days_only(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    value = F.col("value").cast(schemas.MONEY)
    build = lambda: streams.windowed_spend(
        stream(spark, source).withColumn("ts", F.col("ts").cast("timestamp")), "ts", value, ["event_type"], "1 hour", "30 days"
    )
    source = str(tmp_path / "source")
    events = adapters.table(spark, SF, "events").orderBy("ts")
    events.coalesce(1).write.mode("append").parquet(source)
    streams.keep_windows(build(), ["event_type"], path, checkpoint)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in Path(path).glob("window_day=*/part-*")}
    before, days = files(), {p.parent for p in Path(path).glob("window_day=*/part-*")}
    events.limit(1).write.mode("append").parquet(source)
    streams.keep_windows(build(), ["event_type"], path, checkpoint)
    after = files()
    gone = set(before) - set(after)
    assert len({Path(p).parent for p in gone}) == 1 and {Path(p).parent for p in after} == days
    total = streams.current_windows(spark, path, build().schema).agg(F.sum("row_count")).first()[0]
    assert total == 1001


def test_windows_in_append_mode_close_with_a_later_row(spark, landed, tmp_path):
    path, checkpoint = paths(tmp_path)
    source = str(tmp_path / "source")
    events = adapters.table(spark, SF, "events")
    events.write.mode("append").parquet(source)
    value = F.col("value").cast(schemas.MONEY)

    def run():
        timed = stream(spark, source, 100).withColumn("ts", F.col("ts").cast("timestamp"))
        windows = streams.windowed_spend(timed, "ts", value, ["event_type"], "1 hour", "1 day")
        sinks.write_rows(windows, path, checkpoint)

    run()
    closing = events.limit(1).withColumns({"ts": F.lit("2100-01-01").cast("timestamp_ntz"), "event_type": F.lit("closing")})
    closing.write.mode("append").parquet(source)
    run()
    got = sinks.written(spark, path).filter("event_type <> 'closing'")
    batch = events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("window_start"), "event_type")
    expected = batch.agg(F.count(F.lit(1)).alias("row_count"), F.sum(value).alias("total"))
    columns = ["window_start", "event_type", "row_count", "total"]
    assert rows(got, *columns) == rows(expected, *columns)


@pytest.mark.parametrize("hot_rows", [10**9, 3])
def test_a_log_is_delivered_in_order_with_positions(spark, backwards, tmp_path, hot_rows):
    conf = eventlog.LogConfig("files", str(tmp_path / "log"))
    routed = outbox.route(adapters.outbox_of(backwards()), "x")
    streams.deliver(routed, conf, str(tmp_path / "ck"), hot_rows)
    folders = {p.name for p in Path(conf.path).iterdir() if p.name.startswith("topic=")}
    assert folders == {f"topic=x.{t}" for t in ("click", "view", "error", "signup", "purchase")}
    log = eventlog.read_log(spark, conf, streaming=False)
    expected = outbox.route(adapters.outbox_like(spark, SF), "x")
    columns = ["topic", "key", "value", "id", "timestamp"]
    assert rows(log.withColumn("id", eventlog.event_id()), *columns) == rows(expected.withColumn("id", eventlog.event_id()), *columns)
    held: dict = {}
    for batch in range(4):
        for file in sorted(Path(conf.path).glob(f"topic=*/batch_id={batch}/part-*.json"), key=lambda p: p.name):
            for line in file.read_text().splitlines():
                entry = json.loads(line)
                told = {h["key"]: h["value"] for h in entry["headers"]}
                held.setdefault((file.parent.parent.name, entry["key"]), []).append((batch, entry["timestamp"], told["id"], int(told["position"])))
    for entries in held.values():
        assert [e[3] for e in entries] == list(range(1, len(entries) + 1))
        assert [e[:3] for e in entries] == sorted(e[:3] for e in entries)


def test_log_is_read_from_the_beginning_and_replayed_by_a_new_checkpoint(spark, tmp_path):
    conf = eventlog.LogConfig("files", str(tmp_path / "log"), files_per_batch=1)
    at = datetime(2025, 11, 17)
    sent = spark.createDataFrame([(f"m{i}", "hello", "s", at + timedelta(seconds=i)) for i in range(20)], "id string, payload string, source string, at timestamp")
    eventlog.write_log(eventlog.to_message(sent, "x.smoke", "id", ["id", "payload", "source"], "at"), conf)
    for name in ("first", "second"):
        path, checkpoint = paths(tmp_path, name)
        sinks.write_rows(eventlog.from_message(eventlog.read_log(spark, conf)), path, checkpoint)
        assert rows(sinks.written(spark, path), "id", "payload", "source") == rows(sent, "id", "payload", "source")


def test_stream_round_trip_equals_batch(spark, tmp_path):
    start = datetime(2025, 11, 17)
    sent = [(f"m{i}", start + timedelta(seconds=7 * i)) for i in range(60)]
    sent += [(None, start), (None, start + timedelta(seconds=1))]
    back = [(f"m{i}", start + timedelta(seconds=7 * i + k)) for i in range(60) if i % 4 for k in (i % 9 + 2, i % 9, i % 3 - 4)]
    back += [(None, start + timedelta(seconds=1))]
    closing = ("closing", datetime(2100, 1, 1))
    sides = {}
    for name, data, column in (("sent", sent, "published_at"), ("back", back, "consumed_at")):
        kind = f"id string, {column} timestamp"
        sides[name] = spark.createDataFrame(data, kind)
        sides[name].unionByName(sides[name]).write.mode("append").parquet(str(tmp_path / name))
    path, checkpoint = paths(tmp_path)

    def run():
        read = lambda name: spark.readStream.schema(sides[name].schema).parquet(str(tmp_path / name))
        trips = streams.round_trip(read("sent"), read("back"), "id", 5, "1 minute")
        sinks.write_rows(trips, path, checkpoint)

    run()
    for name in sides:
        last = spark.createDataFrame([closing], sides[name].schema)
        last.write.mode("append").parquet(str(tmp_path / name))
    run()
    got = sinks.written(spark, path).filter("id IS DISTINCT FROM 'closing'")
    # null messages are no copies of each other, so both copies of each stay
    lone = sides["sent"].filter("id IS NULL")
    keyed = sides["sent"].filter("id IS NOT NULL").unionByName(lone).unionByName(lone)
    batch = reconcile.round_trip(keyed, sides["back"], ["id"], "5 SECONDS")
    columns = ["id", "published_at", "consumed_at", "latency_ms", "timed_out"]
    assert rows(got, *columns) == rows(batch, *columns)


def test_observed_checks_report_with_the_stream(spark, landed, tmp_path):
    from tallybook.operators.expectations import observed

    watched = observed(stream(spark, landed, 4), "quality", {"value_positive": F.col("value") > 0, "is_click": F.col("event_type") == "click"})
    query = (
        watched.writeStream.option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).foreachBatch(lambda df, n: df.write.format("noop").mode("overwrite").save()).start()
    )
    query.awaitTermination()
    metrics = query.lastProgress.observedMetrics["quality"]
    others = adapters.table(spark, SF, "events").filter("event_type <> 'click'").count()
    assert metrics.is_click == others
