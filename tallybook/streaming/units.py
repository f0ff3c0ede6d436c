"""State changes and their events, appended by batches of one's own; ``streams.append_units`` does it for a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.operators.outbox import checked_events
from tallybook.streaming.files import read_or_empty
from tallybook.streaming.sinks import BATCH, replace_partitions

OUTPUT = "output"


class NoBatchError(RuntimeError):
    """An append was attempted outside a batch."""


def append(state: DataFrame, events: DataFrame, batch_id: int | None, path: str) -> None:
    """Record a batch's state changes and outbox events in one write, which fails as a whole.

    An event that breaks the outbox's rules, or whose id another batch has or comes twice, fails it. A batch that is
    run again takes the place of its earlier run. Ids are held against those of all other batches, a scan of one
    column that grows with the table: a stream of many batches appends by ``streams.append_units``.
    """
    if batch_id is None:
        raise NoBatchError("append needs the id of the batch it belongs to")
    spark = events.sparkSession
    held = read_or_empty(spark, path, f"event struct<id:string>, {OUTPUT} string, {BATCH} long")
    earlier = held.filter((F.col(OUTPUT) == "events") & (F.col(BATCH) != batch_id)).select(F.col("event.id").alias("_id"))
    double = earlier.unionAll(events.select(F.col("id").alias("_id"))).groupBy("_id").count().filter("count > 1")
    message = F.concat(F.lit("duplicate id in outbox event "), F.col("_id"))
    payload = F.when(F.col("_id").isNotNull(), F.raise_error(message)).otherwise(F.col("payload")).cast("string")
    checked = checked_events(events).join(double, F.col("id") == F.col("_id"), "left").withColumn("payload", payload)
    fields = [*schemas.OUTBOX.fieldNames()]
    parts = [
        state.select(F.lit("state").alias(OUTPUT), F.struct(*state.columns).alias("state")),
        checked.select(F.lit("events").alias(OUTPUT), F.struct(*fields).alias("event")),
    ]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    replace_partitions(both.withColumn(BATCH, F.lit(batch_id).cast("long")), path, [OUTPUT, BATCH])


def appended(spark: SparkSession, path: str, output: str) -> DataFrame:
    """The rows of one output, ``state`` or ``events``."""
    part = "event" if output == "events" else "state"
    return spark.read.parquet(path).filter(F.col(OUTPUT) == output).select(f"{part}.*")
