"""Where streams put their rows.

``write_rows`` uses Spark's file sink: its log names the files of finished batches, and readers of the folder see no
others. Several outputs that belong together are rows of one stream, told apart by a column, so a batch shows all of
them or none. ``each_batch`` is for what Spark's sink can't do (update mode, carried values, order); ``write_batch``
gives every batch a partition of its own and overwrites it, so a batch that is run again replaces itself.

A folder belongs to one checkpoint. A replay has a fresh checkpoint and another folder: a run below the same path
(``write_run``), to which readers of the path (``current``) change over once it is through.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tallybook.streaming import files
from tallybook.streaming.ledger import LATE, REPEATED, Ledger, counted

BATCH = "batch_id"
#: Names the runs that readers have changed over to, in order.
_TURNS = "_turns"


class LeftOutError(RuntimeError):
    """A stream did not take all rows as they came."""


class LateRowsError(LeftOutError):
    """A stateful operator found rows later than its delay and left them out."""


class RepeatedRowsError(LeftOutError):
    """Rows whose id was there before were left out."""


class ViolationsError(LeftOutError):
    """Rows broke the checks that the stream observes."""


def _own_folder(spark: SparkSession, path: str, checkpoint: str) -> None:
    if path and not files.exists(spark, f"{checkpoint}/offsets") and files.names(spark, path):
        raise ValueError(f"{path} holds another stream's rows: a replay needs a folder of its own")


def run_to_end(
    writer: DataStreamWriter,
    spark: SparkSession,
    checkpoint: str,
    state_partitions: int | None = None,
    repeated_fail: bool = False,
    settings: dict[str, str] | None = None,
) -> dict[str, int]:
    """Run a stream to the end of what is there; returns what its ledger has counted since its first batch.

    Fails if it has ever left rows out as late, or if rows broke a check that it observes; and, if
    ``repeated_fail``, if it dropped copies. Every shuffle partition of a stateful stream is a store, whose number a
    checkpoint keeps for life: ``spark.sql.shuffle.partitions`` of them, or ``state_partitions``. ``settings`` hold for
    this stream alone.
    """
    name = f"stream-{uuid.uuid4().hex}"
    ledger = Ledger(spark, checkpoint, name)
    asked = dict(settings or {})
    if state_partitions:
        asked["spark.sql.shuffle.partitions"] = str(state_partitions)
    held = {key: spark.conf.get(key, None) for key in asked}
    spark.streams.addListener(ledger)
    try:
        try:
            for key, value in asked.items():
                spark.conf.set(key, value)
            writer = writer.queryName(name).option("checkpointLocation", checkpoint)
            query = writer.trigger(availableNow=True).start()
        finally:
            for key, value in held.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        try:
            query.awaitTermination()
        finally:
            ledger.wait(query)
    finally:
        spark.streams.removeListener(ledger)
    found = counted(spark, checkpoint)
    if found.get(LATE):
        raise LateRowsError(f"{found[LATE]} rows came later than the stream's delay; see split_late")
    if repeated_fail and found.get(REPEATED):
        raise RepeatedRowsError(f"{found[REPEATED]} rows had an id that was there before and were left out")
    broken = {what: n for what, n in found.items() if what not in (LATE, REPEATED)}
    if broken:
        raise ViolationsError(", ".join(f"{what}: {n} rows" for what, n in sorted(broken.items())))
    return found


def write_rows(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    state_partitions: int | None = None,
    repeated_fail: bool = False,
    settings: dict[str, str] | None = None,
) -> dict[str, int]:
    """Append a stream to a folder by Spark's file sink."""
    spark = stream.sparkSession
    _own_folder(spark, path, checkpoint)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return run_to_end(writer, spark, checkpoint, state_partitions, repeated_fail, settings)


def write_run(
    stream: DataFrame, path: str, run: str, checkpoint: str, settings: dict[str, str] | None = None
) -> dict[str, int]:
    """Append a stream to the folder of its ``run`` below ``path``; once it is through, readers change over to it.

    A replay is a run of another name and checkpoint. It takes the place of the run before as a whole, however it is
    cut into batches; one that fails on its way changes nothing for readers. A run that goes on after a later one was
    begun adds to its own folder and does not take readers back.
    """
    spark = stream.sparkSession
    told = write_rows(stream, f"{path}/{run}", checkpoint, settings=settings)
    turns = _turns(spark, path)
    if run not in turns:
        files.put(spark, f"{path}/{_TURNS}/{len(turns):09d}-{run}", "")
    return told


def _turns(spark: SparkSession, path: str) -> list[str]:
    return [name.partition("-")[2] for name in sorted(files.names(spark, f"{path}/{_TURNS}"))]


def current(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last run that got through, and of no other; its finished batches if it goes on."""
    turns = _turns(spark, path)
    if not turns:
        raise ValueError(f"no run of {path} is through")
    return written(spark, f"{path}/{turns[-1]}")


def each_batch(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None],
    mode: str = "append",
    state_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> dict[str, int]:
    """Hand each batch of a stream to ``on_batch``, which writes below ``path``."""
    spark = stream.sparkSession
    _own_folder(spark, path, checkpoint)
    writer = stream.writeStream.outputMode(mode).foreachBatch(on_batch)
    return run_to_end(writer, spark, checkpoint, state_partitions, settings=settings)


def written(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of finished batches; with a ``schema``, none where nothing was written yet."""
    return files.read_or_empty(spark, path, schema) if schema is not None else spark.read.parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """The rows of a batch as its partition of a table, in the place of what an earlier run of it wrote."""
    rows = df.withColumn(BATCH, F.lit(batch_id).cast("long"))
    replace_partitions(rows, path, [*partition_by, BATCH])


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite those partitions of a table that ``df`` has rows for, and no others."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def _batches(spark: SparkSession, path: str) -> list[int]:
    found = (n.removeprefix(f"{BATCH}=") for n in files.names(spark, path) if n.startswith(f"{BATCH}="))
    return sorted(int(n) for n in found)


def carried(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """A small table that every batch writes anew: as the last batch left it, or the last one before ``before``."""
    batches = [n for n in _batches(spark, path) if before is None or n < before]
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batches[-1]}")


def carry(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the table for the next batch; the one before stays for a batch that is run again, older ones go."""
    spark = df.sparkSession
    write_batch(df.coalesce(1), path, batch_id)
    for n in _batches(spark, path):
        if n < batch_id - 1:
            files.remove(spark, f"{path}/{BATCH}={n}")


def write_once(df: DataFrame, path: str) -> None:
    """A table that is written a single time, whole; what a crash left of it is replaced."""
    if not files.exists(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
