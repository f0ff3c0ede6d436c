"""Order-dependent results that never put one key, or the whole table, into one task.

A window over a key is fine while the key is small. A key holding a large share of the rows is
instead cut into *chunks*: the rows are range-partitioned by key and order, written once to the
shared folder, and every per-key result is finished from one summary row per chunk and key.
The table is written because a range partitioning draws its bounds from a sample; two runs of the
same plan may cut differently, while a written chunk number stays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from tallybook.session import new_table_path, released_shuffles, remove_table

# A key above HOT_ROWS rows is handled in chunks; the result is the same either way.
HOT_ROWS = 5_000_000
#: Bytes, as Spark estimates them, that one chunk is meant to hold.
CHUNK_BYTES = 256 << 20
#: Bytes read, by the same estimate, above which rows are ordered in so many slices, each shuffled by itself.
SLICED_BYTES = 128 << 20
SLICES = 4
#: Values of the first order column, at most about, that slices are cut by.
_SAMPLED = 4000
_UNKNOWN_BYTES = 1 << 60  # Spark's estimate for what it can't tell is larger

CHUNK = "_chunk"
PLACE = "_place"
POSITION = "_position"
_ROW = "_row_of_task"
_CONTENT = "_content_hash"
ROW_BITS = 33  # monotonically_increasing_id keeps the row in the low 33 bits, the partition above


def _read_bytes(df: DataFrame) -> int:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN_BYTES)


def chunk_count(df: DataFrame) -> int:
    """At least one chunk for each shuffle partition, more where the tables read hold over CHUNK_BYTES for each."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-_read_bytes(df) // CHUNK_BYTES))


def _cuts(df: DataFrame, first: Column | str) -> list[Column]:
    """Conditions that hold for the rows of one slice each: slices follow each other by the first order column.

    They come of a sample; a value with many rows makes its slice larger, no more. A column in another order than
    Spark's own, or of a nested type, does not cut.
    """
    if not isinstance(first, str) and first._jc.node().getClass().getSimpleName() == "SortOrder":
        return []
    values = df.select((F.col(first) if isinstance(first, str) else first).alias("value"))
    if not isinstance(values.schema["value"].dataType, T.AtomicType):
        return []
    rows = values.count()
    drawn = values.sample(min(1.0, _SAMPLED / max(rows, 1)), 1).filter("value IS NOT NULL").sort("value").collect()
    bounds = sorted({drawn[len(drawn) * k // SLICES]["value"] for k in range(1, SLICES)}) if drawn else []
    value = F.col(first) if isinstance(first, str) else first
    above = [F.lit(True), *(F.coalesce(value > F.lit(x), F.lit(False)) for x in bounds)]  # null comes first
    return [low & ~high for low, high in zip(above, [*above[1:], F.lit(False)])]


def chunked(
    df: DataFrame, order: Sequence[Column | str], chunks: int | None = None, keep_position: bool = False
) -> DataFrame:
    """Range-partition by ``order``, write once, and return with chunk number and place in chunk.

    Chunks follow each other in order. Rows equal in every order column follow a hash of all their columns, and only
    equal rows are told apart by the task and row they come from, so that countless copies of one row still spread
    over chunks, and a task that runs again can't move other rows across a border. Much input is written as it comes and
    then ordered slice by slice, so that the disk never holds the shuffle of all rows. ``POSITION``, kept on
    request, is the chunk in its high bits and the place below: a filter on it skips the other chunks' files.
    """
    spark = df.sparkSession
    path = new_table_path(spark, "chunks")
    order = [*order, F.col(_CONTENT), F.col(_ROW)]
    hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    number = chunks or chunk_count(df)

    def write(part: DataFrame, ahead: int, partitions: int) -> None:
        (
            part.withColumns({_CONTENT: F.xxhash64(*hashed), _ROW: F.monotonically_increasing_id()})
            .repartitionByRange(partitions, *order)
            .sortWithinPartitions(*order)
            .withColumn(POSITION, F.monotonically_increasing_id() + F.lit(ahead << ROW_BITS))
            .drop(_ROW, _CONTENT)
            .write.mode("append").option("compression", "zstd").parquet(path)
        )

    with released_shuffles(spark):  # the table holds the rows from here on
        if _read_bytes(df) <= SLICED_BYTES:
            write(df, 0, number)
        else:
            unordered = new_table_path(spark, "unordered")
            df.write.option("compression", "zstd").parquet(unordered)
            held = spark.read.schema(df.schema).parquet(unordered)
            cuts = _cuts(held, order[0]) or [F.lit(True)]
            each = -(-number // len(cuts))
            for k, cut in enumerate(cuts):
                write(held.filter(cut), k * each, each)
            remove_table(spark, unordered)
    rows = (
        spark.read.parquet(path)
        .withColumn(CHUNK, F.shiftright(POSITION, ROW_BITS))
        .withColumn(PLACE, F.col(POSITION) - F.shiftleft(CHUNK, ROW_BITS))
    )
    return rows if keep_position else rows.drop(POSITION)


def before(window: WindowSpec) -> WindowSpec:
    """All rows of the window ahead of the current one."""
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("bigint"))


def chunk_starts(rows: DataFrame) -> DataFrame:
    """Number of rows ahead of each chunk: one row per chunk, which bounds the un-partitioned window."""
    return (
        rows.groupBy(CHUNK)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(CHUNK, "_rows", _or_zero(F.sum("_rows").over(before(Window.orderBy(CHUNK)))).alias("_start"))
    )


def global_row_number(
    df: DataFrame, order: Sequence[Column | str], out: str, chunks: int | None = None
) -> DataFrame:
    """Zero-based position of every row in the total order, without a single-task window."""
    rows = chunked(df, order, chunks)
    return (
        rows.join(F.broadcast(chunk_starts(rows).drop("_rows")), CHUNK)
        .withColumn(out, F.col("_start") + F.col(PLACE))
        .drop(CHUNK, PLACE, "_start")
    )


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hashes of all keys with more than ``hot_rows`` rows, as a written table.

    Counts are combined per task first. A key that shares a hot key's hash is merely treated alike. There are
    at most as many rows as the input holds multiples of ``hot_rows``.
    """
    sizes = df.groupBy(_key_hash(keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
    path = new_table_path(df.sparkSession, "hot-keys")
    sizes.filter(F.col("_rows") > hot_rows).select("_hash").write.parquet(path)
    return df.sparkSession.read.schema("_hash long").parquet(path)


def split_hot(
    df: DataFrame,
    keys: Sequence[str],
    usual: Callable[[DataFrame], DataFrame],
    heavy: Callable[[DataFrame], DataFrame],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Apply ``usual`` to rows of ordinary keys and ``heavy`` to rows of hot ones.

    Both must return the same columns. Without hot keys, the plan is the usual one alone.
    """
    hot = hot_keys(df, keys, hot_rows)
    if hot.isEmpty():
        return usual(df)
    hashed = df.withColumn("_hash", _key_hash(keys))
    part = lambda how: hashed.join(hot, "_hash", how).drop("_hash")
    return usual(part("left_anti")).unionByName(heavy(part("left_semi")))


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "sequence",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One-based number of each row within its key, by a total order."""

    def usual(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(out, F.row_number().over(w).cast("bigint"))

    def heavy(rows: DataFrame) -> DataFrame:
        cut = chunked(rows, [*keys, *order])
        spans = span_summary(cut, keys, F.count(F.lit(1)).alias("_rows"))
        start = _or_zero(F.sum("_rows").over(before(span_window(keys))))
        place = F.row_number().over(chunk_window(keys))
        numbered = join_spans(
            cut.withColumn("_in_chunk", place), spans.withColumn("_start", start).drop("_rows"), keys
        ).withColumn(out, F.col("_start") + F.col("_in_chunk"))
        return numbered.drop(CHUNK, PLACE, "_start", "_in_chunk")

    return split_hot(df, keys, usual, heavy, hot_rows)


def chunk_window(keys: Sequence[str]) -> WindowSpec:
    """Window over one key inside one chunk, in order."""
    return Window.partitionBy(CHUNK, *keys).orderBy(PLACE)


def span_window(keys: Sequence[str]) -> WindowSpec:
    """Window over the chunks of one key, in order."""
    return Window.partitionBy(*keys).orderBy(CHUNK)


def span_summary(cut: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row per chunk and key: for hot keys, no more than their number plus that of the chunks."""
    return cut.groupBy(CHUNK, *keys).agg(*aggregates)


def join_spans(cut: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring chunk summaries back to the rows, matching null keys too."""
    names = {c: f"_span_{c}" for c in (CHUNK, *keys)}
    small = spans.withColumnsRenamed(names)
    match = None
    for c, name in names.items():
        same = F.col(c).eqNullSafe(F.col(name))
        match = same if match is None else match & same
    return cut.join(small, match).drop(*names.values())


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key by a total order.

    Catalyst keeps only each task's own first row per key before the shuffle (a partial window
    group limit), so even a key made of countless copies crosses it as one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
