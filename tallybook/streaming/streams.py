"""Streams over event logs: ingest, append, deduplicate, route, match, window, audit, quarantine.

Every stream runs to the end of what is there (``availableNow``) and resumes from its checkpoint; a new checkpoint
replays the log from its beginning, into a folder of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import schemas
from tallybook.functions.text import elapsed_millis
from tallybook.operators import reconcile
from tallybook.operators.expectations import observed
from tallybook.operators.ordering import HOT_ROWS, number_within
from tallybook.operators.outbox import checked_cursor, checked_payload, included
from tallybook.operators.outbox import dedup as dedup_batch
from tallybook.sources import eventlog
from tallybook.streaming.files import read_or_empty
from tallybook.streaming.sinks import (
    BATCH,
    carried,
    carry,
    each_batch,
    replace_partitions,
    write_batch,
    write_once,
    write_rows,
    written,
)
from tallybook.streaming.standing import ON_DISK, with_standing

OUTPUT, DAY = "output", "window_day"


def append_units(units: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None) -> None:
    """Record state changes and their outbox events, each pair both or neither.

    A unit is a row of the outbox's columns and a struct ``state``; what other columns it has, as the delivery that it
    came with, go along with both parts. Both parts are rows of one write, so a batch shows both or none. A row that
    breaks the outbox's rules fails its batch, of which nothing becomes visible. A unit
    whose id was appended before, in whichever batch, is left out with both parts, and the run fails with their
    number; the ids are held by the state store on disk, where looking one up costs the same however many there are.
    """
    events = [*schemas.OUTBOX.fieldNames()]
    checked = units.withColumn("payload", checked_payload()).dropDuplicates(["id"])
    state, event = F.col("state"), F.struct(*events)
    along = [name for name in units.columns if name not in (*events, "state")]
    none = lambda part: F.lit(None).cast(part)
    state_type, event_type = units.schema["state"].dataType, units.select(event.alias("e")).schema["e"].dataType
    parts = F.array(
        F.struct(F.lit("state").alias(OUTPUT), state.alias("state"), none(event_type).alias("event")),
        F.struct(F.lit("events").alias(OUTPUT), none(state_type).alias("state"), event.alias("event")),
    )
    tagged = checked.select(F.inline(parts), *along)
    write_rows(tagged, path, checkpoint, [OUTPUT], state_partitions, repeated_fail=True, settings=ON_DISK)


def appended(spark: SparkSession, path: str, output: str) -> DataFrame:
    """The rows of one output (``state`` or ``events``) of finished batches; the other's files are not read."""
    part = "event" if output == "events" else "state"
    rows = written(spark, path)
    along = [name for name in rows.columns if name not in (OUTPUT, "state", "event")]
    return rows.filter(F.col(OUTPUT) == output).select(f"{part}.*", *along)


def ingest(
    stream: DataFrame, path: str, checkpoint: str, source: Column, token: Column, updated: Column
) -> None:
    """Land a feed batch by batch; each source's cursor is saved after the page that it belongs to.

    The cursor is the highest token read, compared in the token's own type, with the latest time seen. It is taken
    from the page as written, so it never names a row that is not there.
    """
    spark, schema = stream.sparkSession, stream.schema
    kind = stream.select(token.alias("token")).schema["token"].dataType

    def on_batch(df: DataFrame, batch_id: int) -> None:
        write_batch(df, f"{path}/rows", batch_id)
        page = read_or_empty(spark, f"{path}/rows/{BATCH}={batch_id}", schema)
        read = page.select(source.cast("string").alias("source"), token.alias("_token"), updated.alias("updated_at"))
        saved = carried(spark, f"{path}/cursor", schemas.CURSOR, batch_id)
        saved = saved.select("source", F.col("last_token").cast(kind).alias("_token"), "updated_at")
        cursor = saved.unionByName(read).groupBy("source").agg(
            F.max("_token").cast("string").alias("last_token"), F.max("updated_at").alias("updated_at")
        )
        carry(checked_cursor(cursor), f"{path}/cursor", batch_id)

    each_batch(stream, path, checkpoint, on_batch)


def read_cursor(spark: SparkSession, path: str) -> DataFrame:
    """The cursors that ``ingest`` saved; none before its first batch."""
    return carried(spark, f"{path}/cursor", schemas.CURSOR)


def after_token(df: DataFrame, key: str, last_token) -> DataFrame:
    """Batch form of resuming: rows beyond the last token, a predicate the scan can use."""
    return df if last_token is None else df.filter(F.col(key) > F.lit(last_token))


def beyond_cursor(df: DataFrame, source: Column, token: Column, cursor: DataFrame) -> DataFrame:
    """Rows of each source beyond the token its cursor holds; all of a source without one.

    Tokens are compared in the feed's own type.
    """
    kind = df.select(token.alias("token")).schema["token"].dataType
    held = cursor.select(F.col("source").alias("_source"), F.col("last_token").cast(kind).alias("_token"))
    joined = df.join(held, source.cast("string") == F.col("_source"), "left")
    return joined.filter(F.col("_token").isNull() | (token > F.col("_token"))).select(*df.columns)


def capture(
    snapshot: DataFrame, changes: DataFrame, tables: Sequence[str], path: str, checkpoint: str
) -> None:
    """The snapshot, then the change stream, as one log; each event once, the snapshot's copy first.

    The snapshot is written once, by itself, before the first change; changes it holds are left out, and so are
    copies of a change, however far apart they come.
    """
    spark = snapshot.sparkSession
    read = included(snapshot.withColumn("op", F.lit("r")), tables)
    write_once(dedup_batch(read, ["id"], ["created_at", "payload"]), f"{path}/snapshot")
    held = written(spark, f"{path}/snapshot").select("id")
    once = dedup_exact(included(changes, tables), "id")
    write_rows(reconcile.drop_seen(once, held, ["id"]), f"{path}/changes", checkpoint)


def captured(spark: SparkSession, path: str) -> DataFrame:
    """The log that ``capture`` wrote."""
    snapshot = written(spark, f"{path}/snapshot")
    changes = written(spark, f"{path}/changes", snapshot.schema)
    return snapshot.unionByName(changes.select(*snapshot.columns))


def dedup_exact(stream: DataFrame, key: str) -> DataFrame:
    """Each key's first copy, however late the others come; rows without a key all stay.

    The state holds every key ever seen, so use the RocksDB state store on long streams: a batch then costs what it
    brings, not what went before. Where copies are known to come close together, ``dedup`` forgets old keys.
    """
    return stream.filter(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(stream.filter(F.col(key).isNull()))


def dedup(df: DataFrame, key: str | Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other; rows without a key all stay.

    A row later than ``delay`` may be a first copy. It is left out, and the run that writes the stream fails with
    their number; ``split_late`` puts such rows aside first, ``dedup_exact`` has no such limit.
    """
    keys = [key] if isinstance(key, str) else list(key)
    marked = df.withWatermark(time, delay)
    missing = F.lit(False)
    for name in keys:
        missing = missing | F.col(name).isNull()
    return marked.filter(~missing).dropDuplicatesWithinWatermark(keys).unionByName(marked.filter(missing))


_NEWEST = T.StructType([T.StructField("newest", T.TimestampType())])


def split_late(stream: DataFrame, time: str, delay: str, path: str, checkpoint: str) -> None:
    """Write each batch's rows as ``rows``, or as ``late`` where they are older than ``delay`` allows.

    Late is a row older than the newest time of all earlier batches by more than ``delay``: what a watermark would
    leave out. Nothing is lost: both outputs together are the input.
    """
    spark = stream.sparkSession

    def on_batch(df: DataFrame, batch_id: int) -> None:
        saved = carried(spark, f"{path}/newest", _NEWEST, batch_id)
        newest = saved.agg(F.max("newest").alias("_newest"))  # one row
        late = F.coalesce(F.col(time) < F.col("_newest") - F.expr(f"INTERVAL {delay}"), F.lit(False))
        marked = df.join(F.broadcast(newest)).withColumn(OUTPUT, F.when(late, "late").otherwise("rows")).drop("_newest")
        write_batch(marked, f"{path}/rows", batch_id, [OUTPUT])
        now = saved.unionAll(df.agg(F.max(time).cast("timestamp"))).agg(F.max("newest").alias("newest"))
        carry(now, f"{path}/newest", batch_id)

    each_batch(stream, path, checkpoint, on_batch)


def split_rows(spark: SparkSession, path: str, output: str) -> DataFrame:
    """The ``rows`` or the ``late`` rows that ``split_late`` wrote, with their batch."""
    return written(spark, f"{path}/rows").filter(F.col(OUTPUT) == output).drop(OUTPUT)


def checked_rows(stream: DataFrame, name: str, every: dict[str, Column], path: str, checkpoint: str) -> None:
    """Append a stream whose rows must hold all checks; what breaks them is counted and fails the run at its end."""
    write_rows(observed(stream, name, every), path, checkpoint)


def windowed_spend(
    df: DataFrame, time: str, value: Column, keys: Sequence[str], width: str, delay: str
) -> DataFrame:
    """Rows and total value per key and tumbling window; rows later than ``delay`` are dropped."""
    return (
        df.withWatermark(time, delay)
        .groupBy(F.window(time, width), *keys)
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(value).alias("total"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "row_count",
            "total",
        )
    )


def keep_windows(windows: DataFrame, keys: Sequence[str], path: str, checkpoint: str) -> None:
    """Keep one current row per window and key, from an update-mode stream.

    The table is partitioned by the day of the windows' start. A batch reads and overwrites the days of the windows
    that it touches, and no others; a batch run again writes the same values.
    """
    spark, schema = windows.sparkSession, T.StructType([*windows.schema, T.StructField(DAY, T.DateType())])

    def on_batch(df: DataFrame, batch_id: int) -> None:
        changed = df.withColumn(DAY, F.to_date("window_start")).persist()
        try:
            span = changed.agg(F.min(DAY), F.max(DAY)).first()
            if span[0] is None:
                return
            here = read_or_empty(spark, path, schema).filter(F.col(DAY).between(*map(F.lit, span)))
            touched = changed.select(F.col(DAY).alias("_day")).distinct()
            here = here.join(touched, F.col(DAY) == F.col("_day"), "left_semi")
            again = changed.select("window_start", *keys).withColumnsRenamed({k: f"_{k}" for k in ("window_start", *keys)})
            same = F.col("window_start") == F.col("_window_start")
            for key in keys:
                same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
            rest = here.join(again, same, "left_anti")
            now = changed.unionByName(rest.select(*changed.columns))
            replace_partitions(now.hint("rebalance", F.col(DAY)), path, [DAY])
        finally:
            changed.unpersist()

    each_batch(windows, path, checkpoint, on_batch, mode="update")


def current_windows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The windows that ``keep_windows`` keeps."""
    held = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    return written(spark, path, held).drop(DAY)


def round_trip(
    published: DataFrame, consumed: DataFrame, key: str, bound_seconds: int, delay: str
) -> DataFrame:
    """Each message once, with its first consumption within a bound, or as timed out.

    Exact copies within ``delay`` are dropped on both sides first. A message comes out when the watermark has passed
    its bound, as until then an earlier consumption may still come; the consumptions that matched are reduced to
    the first in time by a second stateful operator behind the join. A message without a key matches nothing.
    """
    names = published.columns
    sent = dedup(published, [key, "published_at"], "published_at", delay)
    seen = dedup(consumed.select(key, "consumed_at"), [key, "consumed_at"], "consumed_at", delay).alias("seen")
    keyed = sent.filter(F.col(key).isNotNull()).alias("sent")
    limit = F.col("sent.published_at") + F.expr(f"INTERVAL {bound_seconds} SECONDS")
    match = (
        (F.col(f"sent.{key}") == F.col(f"seen.{key}"))
        & (F.col("seen.consumed_at") >= F.col("sent.published_at"))
        & (F.col("seen.consumed_at") <= limit)
    )
    met = keyed.join(seen, match, "left_outer").select(
        *(F.col(f"sent.{c}") for c in names), F.col("seen.consumed_at").alias("_consumed")
    )
    # one group per message, as copies are gone: its other columns come along
    rest = [c for c in names if c not in (key, "published_at")]
    first = met.groupBy(key, "published_at").agg(
        *(F.first(c).alias(c) for c in rest), F.min("_consumed").alias("consumed_at")
    )
    lone = published.filter(F.col(key).isNull()).withColumn("consumed_at", F.lit(None).cast("timestamp"))
    return first.select(*names, "consumed_at").unionByName(lone).select(
        "*",
        elapsed_millis(F.col("published_at"), F.col("consumed_at")).alias("latency_ms"),
        F.col("consumed_at").isNull().alias("timed_out"),
    )


def quarantine(df: DataFrame, schema: T.StructType, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Split rows into those whose JSON fits ``schema``, expanded, and those kept as they came.

    ``judged`` gives both in one pass.
    """
    parsed = judged(df, schema, column)
    rest = [c for c in df.columns if c != column]
    good_rows = parsed.filter("NOT _bad").select(*rest, *(f"_body.{f.name}" for f in schema))
    return good_rows, parsed.filter("_bad").select(*df.columns)


def judged(df: DataFrame, schema: T.StructType, column: str = "payload") -> DataFrame:
    """Rows with their JSON parsed as ``_body``, and ``_bad`` where it doesn't fit ``schema``."""
    with_fault = T.StructType([*schema.fields, T.StructField("_fault", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_fault"}
    parsed = df.withColumn("_body", F.from_json(column, with_fault, options))
    return parsed.withColumn("_bad", F.col("_body").isNull() | F.col("_body._fault").isNotNull())


def parse_strictly(df: DataFrame, schema: T.StructType, column: str = "payload") -> DataFrame:
    """Expand JSON; one malformed row fails the whole batch."""
    body = F.from_json(column, schema, {"mode": "FAILFAST"})
    rest = [c for c in df.columns if c != column]
    return df.withColumn("_body", body).select(*rest, "_body.*")


def sequence_audit(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    created: str,
    arrival: str,
    hot_rows: int = HOT_ROWS,
    state_partitions: int | None = None,
) -> dict[str, int]:
    """Run the arrival audit over a stream, into a table of one partition per batch.

    What a key had before a batch comes from the state store (see ``with_standing``) with every row; the batch is then
    audited as a table, so that a key which fills it is split as in the batch form.
    """
    names = stream.columns

    def on_batch(df: DataFrame, batch_id: int) -> None:
        events = df.persist()
        try:
            earlier = events.groupBy(F.col(key).alias("key")).agg(
                F.max("_arrived_before").alias("arrived"), F.max("_newest_before").alias("newest")
            )
            audited = reconcile.sequence_audit(events.select(*names), key, created, arrival, earlier, hot_rows)
            write_batch(audited, path, batch_id)
        finally:
            events.unpersist()

    standing = with_standing(stream.withColumn(key, F.col(key).cast("string")), [key], created)
    return each_batch(standing, path, checkpoint, on_batch, state_partitions=state_partitions, settings=ON_DISK)


def deliver(
    log: DataFrame, conf: eventlog.LogConfig, checkpoint: str, hot_rows: int = HOT_ROWS, state_partitions: int | None = None
) -> None:
    """Write a stream of log entries into a log, those of one topic and key in order of creation within each batch.

    Every entry gets its position within its key, which goes on from batch to batch: what the key had before comes
    from the state store. A batch is delivered when it is there; an entry older than those of earlier batches comes
    behind them, with a higher position.
    """
    keys = ["topic", "key"]

    def on_batch(df: DataFrame, batch_id: int) -> None:
        entries = df.persist()
        try:
            named = entries.withColumn("_id", eventlog.event_id())
            numbered = number_within(named, keys, ["timestamp", "_id", "value"], "_number", hot_rows)
            numbered = numbered.withColumn("_number", F.col("_number") + F.col("_arrived_before"))
            eventlog.write_log(eventlog.placed(numbered, "_number"), conf, batch_id)
        finally:
            entries.unpersist()

    standing = with_standing(log, keys, "timestamp")
    each_batch(standing, conf.path or "", checkpoint, on_batch, state_partitions=state_partitions, settings=ON_DISK)
