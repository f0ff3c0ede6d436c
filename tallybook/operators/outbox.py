"""Outbox events: build, capture, route, expand, order, retain; and the poll cursor's upsert."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import schemas
from tallybook.functions.text import content_id, topic_name
from tallybook.operators.ordering import HOT_ROWS, first_per_key, number_within


def to_events(
    df: DataFrame,
    aggregate_type: Column,
    aggregate_id: Column,
    event_type: Column,
    payload_columns: Sequence[str],
    created_at: Column | None = None,
    replayable: bool = True,
) -> DataFrame:
    """Outbox rows for state rows, the payload being JSON of the named columns.

    A replayable id is a digest of the event, so writing a batch again gives the same ids; it needs
    a ``created_at`` of the data's own. Otherwise ids are random and the time is now.
    """
    if replayable and created_at is None:
        raise ValueError("a replayable event needs created_at from the data")
    payload = F.to_json(F.struct(*payload_columns))
    stamped = F.current_timestamp() if created_at is None else created_at
    identity = (
        content_id(aggregate_type, aggregate_id, event_type, F.unix_micros(stamped), payload)
        if replayable
        else F.uuid()
    )
    return df.select(
        identity.alias("id"),
        aggregate_type.cast("string").alias("aggregate_type"),
        aggregate_id.cast("string").alias("aggregate_id"),
        event_type.cast("string").alias("type"),
        payload.alias("payload"),
        stamped.alias("created_at"),
    )


def checked_payload() -> Column:
    """The payload of an outbox row; it fails the job which reads it if the row breaks any of the table's rules."""
    c = F.col
    missing = None
    for name in schemas.OUTBOX.fieldNames():
        missing = c(name).isNull() if missing is None else missing | c(name).isNull()
    too_long = F.lit(False)
    for name, limit in schemas.OUTBOX_MAX_LENGTH.items():
        too_long = too_long | (F.length(name) > limit)
    fault = (
        F.when(missing, "missing value")
        .when(too_long, "value too long")
        .when(F.try_parse_json("payload").isNull(), "malformed payload")
    )
    message = F.concat(fault, F.lit(" in outbox event "), F.coalesce(c("id"), F.lit("without id")))
    return F.when(fault.isNotNull(), F.raise_error(message)).otherwise(c("payload")).cast("string")


def checked_events(events: DataFrame) -> DataFrame:
    """Outbox rows that fail the job which reads them if any breaks the table's rules."""
    return events.select(*schemas.OUTBOX.fieldNames()).withColumn("payload", checked_payload())


def included(changes: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Change records of the listed ``schema.table`` names that carry a row (no updates, deletes).

    Schema and table are compared column by column, so that the scan can use the condition.
    """
    listed = F.lit(False)
    for name in tables:
        schema, _, table = name.partition(".")
        listed = listed | ((F.col("source_schema") == schema) & (F.col("source_table") == table))
    return changes.filter(listed & F.col("op").isin("r", "c"))


def capture(snapshot: DataFrame, changes: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Initial snapshot and later changes as one log, each event once.

    The two overlap; the snapshot's copy of an event wins.
    """
    tables = tuple(tables)
    read = snapshot.withColumn("op", F.lit("r"))
    both = included(read.unionByName(changes), tables)
    return dedup(both, ["id"], [F.col("op").desc(), "created_at", "payload"])


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Exact deduplication; the first copy by ``order`` survives. Rows without a key are no copies and all stay."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return first_per_key(df.filter(~missing), keys, order).unionByName(df.filter(missing))


def route(events: DataFrame, prefix: str) -> DataFrame:
    """Events as log entries: topic by aggregate type, key by aggregate, id and type as headers."""
    c = F.col
    header = lambda name: F.struct(F.lit(name).alias("key"), c(name).alias("value"))
    return events.select(
        topic_name(prefix, c("aggregate_type")).alias("topic"),
        c("aggregate_id").alias("key"),
        c("payload").alias("value"),
        F.array(header("id"), header("type")).alias("headers"),
        c("created_at").alias("timestamp"),
    )


def expand(df: DataFrame, schema: T.StructType | str, column: str = "payload") -> DataFrame:
    """Replace a JSON column by its fields."""
    rest = [c for c in df.columns if c != column]
    return df.withColumn("_body", F.from_json(column, schema)).select(*rest, "_body.*")


def payload_field(column: str, path: str, kind: str) -> Column:
    """One field of a payload of any shape; null where it is absent or of another type."""
    return F.try_variant_get(F.try_parse_json(column), path, kind)


def ordered(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Events with their number within the aggregate, in order of creation."""
    return number_within(events, ["aggregate_id"], ["created_at", "id"], "sequence", hot_rows)


def in_creation_order(events: DataFrame) -> DataFrame:
    return events.orderBy("created_at", "id")


def topic_leakage(routed: DataFrame, identity: str = "id") -> DataFrame:
    """Events seen on more than one topic; empty when routing is clean."""
    return (
        routed.groupBy(identity)
        .agg(F.min("topic").alias("first_topic"), F.max("topic").alias("last_topic"))
        .filter("first_topic <> last_topic")
    )


def retain(events: DataFrame, cutoff) -> DataFrame:
    """Events not older than ``cutoff``."""
    return events.filter(F.col("created_at") >= F.lit(cutoff))


def write_by_date(events: DataFrame, path: str) -> None:
    """Append events to a table partitioned by day of creation; the partitions serve as time index.

    The rebalance gathers each day into few files, and splits a day too large for one task.
    """
    dated = events.withColumn("created_date", F.to_date("created_at"))
    dated.hint("rebalance", F.col("created_date")).write.mode("append").partitionBy("created_date").parquet(path)


def retained(spark: SparkSession, path: str, cutoff) -> DataFrame:
    """Events of a table by date that are not older than ``cutoff``; earlier days are never read."""
    days = spark.read.parquet(path).filter(F.col("created_date") >= F.lit(cutoff).cast("date"))
    return retain(days, cutoff)


def _day_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Day and folder of each partition, from the folders' names alone."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    names = {x.getPath().getName(): x.getPath().toString() for x in listed}
    return {n.split("=", 1)[1]: p for n, p in names.items() if n.startswith("created_date=")}


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def expired_days(spark: SparkSession, path: str, cutoff: date) -> list[str]:
    """Days wholly before the day of ``cutoff``, whose partitions may be removed; no file is opened."""
    return sorted(day for day in _day_folders(spark, path) if day < cutoff.strftime("%Y-%m-%d"))


def drop_expired(spark: SparkSession, path: str, cutoff: datetime) -> list[str]:
    """Remove what is older than ``cutoff`` (in the session's zone): whole days, and the rows of its own day.

    The rows to keep of that day are written before its old files go, so a crash may leave copies, never a gap.
    """
    days = _day_folders(spark, path)
    expired = expired_days(spark, path, cutoff)
    for day in expired:
        _remove(spark, days[day])
    today = cutoff.strftime("%Y-%m-%d")
    if today in days:
        old = spark.read.parquet(days[today])
        if not old.filter(F.col("created_at") < F.lit(cutoff)).isEmpty():
            files = old.inputFiles()
            retain(old, cutoff).write.mode("append").parquet(days[today])
            for file in files:
                _remove(spark, file)
    return expired


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by a total order."""
    return first_per_key(df, keys, [F.col(c).desc() for c in order])


def checked_cursor(cursor: DataFrame) -> DataFrame:
    """Cursor rows that fail the job which reads them if a value is missing or too long."""
    fault = F.when(F.col("source").isNull() | F.col("updated_at").isNull(), "missing value in cursor")
    for name, limit in schemas.CURSOR_MAX_LENGTH.items():
        fault = fault.when(F.length(name) > limit, f"{name} too long in cursor")
    columns = schemas.CURSOR.fieldNames()
    source = F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(F.col("source"))
    return cursor.select(source.cast("string").alias("source"), *columns[1:])


def upsert_cursor(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Cursor table after saving ``updates``: one row per source, the newest wins.

    At an equal time an update beats the saved row, and among updates the higher token wins, compared as a number
    where it is one.
    """
    columns = schemas.CURSOR.fieldNames()
    saved = current.select(*columns, F.lit(0).alias("_new"))
    both = saved.unionByName(updates.select(*columns, F.lit(1).alias("_new")))
    both = both.withColumn("_number", F.expr("try_cast(last_token AS decimal(38, 0))"))
    newest = latest(both, ["source"], ["updated_at", "_new", "_number", "last_token"])
    return checked_cursor(newest.select(*columns))
