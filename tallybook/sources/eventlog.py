"""Keyed JSON event log: Kafka where its connector is installed, else a folder of JSON lines.

Both give the columns ``topic, key, value, headers, timestamp``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import schemas

# JSON text keeps milliseconds unless told otherwise.
_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@dataclass(frozen=True)
class LogConfig:
    """Where an event log lives. ``format`` is ``kafka`` or ``files``."""

    format: str
    path: str | None = None
    servers: str | None = None
    topics: tuple[str, ...] = ()
    files_per_batch: int | None = None
    offsets_per_batch: int | None = None
    options: dict[str, str] = field(default_factory=dict)


def _kafka_columns(raw: DataFrame) -> DataFrame:
    headers = F.transform(
        "headers",
        lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")),
    )
    return raw.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        headers.alias("headers"),
        "timestamp",
    )


def read_log(spark: SparkSession, conf: LogConfig, streaming: bool = True) -> DataFrame:
    """Read a log from its beginning; a stream's checkpoint resumes it where it stopped.

    An entry that was delivered in order has its ``position`` within the key in its headers.
    """
    reader = spark.readStream if streaming else spark.read
    if conf.format == "kafka":
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", conf.servers)
            .option("subscribe", ",".join(conf.topics))
            .option("startingOffsets", "earliest")
            .option("includeHeaders", "true")
            .options(**conf.options)
        )
        if streaming and conf.offsets_per_batch:
            reader = reader.option("maxOffsetsPerTrigger", conf.offsets_per_batch)
        return _kafka_columns(reader.load())
    if conf.format != "files":
        raise ValueError(f"unknown log format {conf.format!r}")
    reader = reader.schema(schemas.EVENT_LOG).options(**_MICROS, **conf.options)
    if streaming and conf.files_per_batch:
        reader = reader.option("maxFilesPerTrigger", conf.files_per_batch)
    log = reader.json(conf.path).select(*schemas.EVENT_LOG.fieldNames())
    return log.filter(F.col("topic").isin(*conf.topics)) if conf.topics else log


def _kafka_rows(df: DataFrame) -> DataFrame:
    headers = F.transform(
        "headers",
        lambda h: F.struct(h["key"].alias("key"), h["value"].cast("binary").alias("value")),
    )
    return df.select("topic", "key", "value", headers.alias("headers"))


def _log_columns(df: DataFrame) -> DataFrame:
    return df.select(*schemas.EVENT_LOG.fieldNames())


def event_id(headers: str = "headers"):
    return F.get(F.filter(headers, lambda h: h["key"] == "id"), F.lit(0))["value"]


def position(headers: str = "headers"):
    """Where an entry stands among those of its topic and key, from 1 on; null if it was not delivered in order."""
    return F.get(F.filter(headers, lambda h: h["key"] == "position"), F.lit(0))["value"].cast("long")


def placed(df: DataFrame, number: str) -> DataFrame:
    """Log entries with the number in column ``number`` as their ``position`` header."""
    header = F.struct(F.lit("position").alias("key"), F.col(number).cast("string").alias("value"))
    held = F.coalesce("headers", F.array().cast(schemas.EVENT_LOG["headers"].dataType))
    return df.withColumn("headers", F.array_append(held, header.cast(schemas.LABEL))).drop(number)


def delivery_order(df: DataFrame) -> DataFrame:
    """Rows of one topic and key in one task, in order of creation, then id: what a keyed log needs."""
    return df.repartition("topic", "key").sortWithinPartitions("topic", "key", "timestamp", event_id())


def file_order(df: DataFrame) -> DataFrame:
    """Rows by topic, key, creation and id over all tasks: files follow each other, so a large key may fill several."""
    order = ["topic", "key", F.col("timestamp"), event_id()]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_log(df: DataFrame, conf: LogConfig, batch_id: int | None = None) -> None:
    """Append rows; each goes to the topic it names, those of one key in order of creation.

    In files, the rows of a ``batch_id`` take the place of what an earlier run of that batch wrote. Kafka may then
    have an entry twice, with one position.
    """
    if conf.format == "kafka":
        (
            _kafka_rows(delivery_order(df))
            .write.format("kafka")
            .option("kafka.bootstrap.servers", conf.servers)
            .options(**conf.options)
            .save()
        )
        return
    if conf.format != "files":
        raise ValueError(f"unknown log format {conf.format!r}")
    rows = file_order(_log_columns(df))
    if batch_id is None:
        writer = rows.write.mode("append").partitionBy("topic")
    else:
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast(T.LongType()))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("topic", "batch_id")
    writer.options(**_MICROS, **conf.options).json(conf.path)


def to_message(df: DataFrame, topic: str, key: str, columns: list[str], timestamp: str) -> DataFrame:
    """Rows as log entries: JSON of ``columns`` under ``key``."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*columns)).alias("value"),
        F.lit(None).cast(schemas.EVENT_LOG["headers"].dataType).alias("headers"),
        F.col(timestamp).alias("timestamp"),
    )


def from_message(log: DataFrame, schema=schemas.MESSAGE) -> DataFrame:
    """Log entries with their JSON value expanded to fields."""
    return log.select(
        "topic", "key", "timestamp", F.from_json("value", schema).alias("message")
    ).select("topic", "key", "timestamp", "message.*")
