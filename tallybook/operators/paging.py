"""Fixed-size pages of an ordered feed, and the check that a walk over them returns every row once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import decode_token
from tallybook.operators.ordering import CHUNK, PLACE, POSITION, ROW_BITS, chunk_starts, chunked, global_row_number


#: Rows of the pages that are regrouped at once.
RANGE_ROWS = 20_000_000


@dataclass(frozen=True)
class NumberedFeed:
    """A feed in order, written once in chunks, with the number of rows ahead of each chunk."""

    rows: DataFrame
    starts: list[tuple[int, int, int]]  # chunk, rows ahead of it, rows in it

    @property
    def size(self) -> int:
        return sum(rows for _, _, rows in self.starts)


def number_feed(df: DataFrame, order: Sequence[Column | str], chunks: int | None = None) -> NumberedFeed:
    """Sort and write a feed, so that any of its pages is read from the chunk that holds it.

    The driver holds three numbers per chunk.
    """
    rows = chunked(df, order, chunks, keep_position=True)
    starts = chunk_starts(rows).select(CHUNK, "_start", "_rows").orderBy(CHUNK).collect()
    return NumberedFeed(rows, [tuple(row) for row in starts])


def offset_of(feed: NumberedFeed, token: str | None) -> int:
    """Offset a token names in this feed."""
    spark = feed.rows.sparkSession
    decoded = decode_token(F.lit(token).cast("string"), F.lit(feed.size).cast("bigint"))
    return spark.range(1).select(decoded.alias("offset")).first()["offset"]


def page(feed: NumberedFeed, token: str | None, size: int) -> DataFrame:
    """The page a token names, with the next token on each row (null on the last page).

    Chunks are stored in the order of their position, so the scan skips those that the page does not touch.
    """
    offset = offset_of(feed, token)
    end = min(offset + size, feed.size)
    following = F.lit(str(end) if end < feed.size else None).cast("string")
    parts = F.lit(False)
    for chunk, start, rows in feed.starts:
        if start < end and offset < start + rows:
            first, last = max(offset - start, 0), min(end - start, rows) - 1
            position = chunk << ROW_BITS
            parts = parts | F.col(POSITION).between(position + first, position + last)
    return feed.rows.filter(parts).sort(POSITION).drop(CHUNK, PLACE, POSITION).withColumn("next_token", following)


def early_page(df: DataFrame, order: Sequence[Column | str], token: str | None, size: int) -> DataFrame:
    """The page a token names, for pages near the feed's start: tasks keep the rows up to the page's end, no more.

    The same as ``page``, without sorting and writing the feed; a deep page costs all rows ahead of it.
    """
    spark = df.sparkSession
    rows = df.count()
    decoded = decode_token(F.lit(token).cast("string"), F.lit(rows).cast("bigint"))
    offset = spark.range(1).select(decoded.alias("offset")).first()["offset"]
    end = min(offset + size, rows)
    following = F.lit(str(end) if end < rows else None).cast("string")
    return df.orderBy(*order).offset(offset).limit(size).withColumn("next_token", following)


def assign_pages(df: DataFrame, order: Sequence[Column | str], size: int) -> DataFrame:
    """Every row with the number of its page and its place there: a whole walk in one job."""
    numbered = global_row_number(df, order, "_position")
    return numbered.select(
        *df.columns,
        F.floor(F.col("_position") / size).cast("bigint").alias("page"),
        (F.col("_position") % size).cast("bigint").alias("page_row"),
    )


def page_ranges(pages: DataFrame, size: int, rows: int | None = None) -> Iterator[DataFrame]:
    """The pages of a walk, a range of about ``rows`` rows after the other: what regroups them moves no more at once."""
    last = pages.agg(F.max("page")).first()[0] or 0
    most = max(1, (rows or RANGE_ROWS) // size)
    if last < most:
        yield pages
        return
    for first in range(0, last + 1, most):
        yield pages.filter(F.col("page").between(first, first + most - 1))


def page_sizes(pages: DataFrame, size: int) -> DataFrame:
    """Rows per page and the token that names the page after it (null on the last)."""
    last = pages.agg(F.max("page")).first()[0]
    following = ((F.col("page") + 1) * size).cast("string")
    return (
        pages.groupBy("page")
        .agg(F.count(F.lit(1)).alias("page_rows"))
        .withColumn("next_token", F.when(F.col("page") < F.lit(last), following))
    )


def page_walk_diff(pages: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys the walk returned more or less often than the source holds them; empty if it is exact."""
    walked = pages.select(*key, F.lit(1).alias("walked"), F.lit(0).alias("held"))
    held = source.select(*key, F.lit(0).alias("walked"), F.lit(1).alias("held"))
    return (
        walked.unionAll(held)
        .groupBy(*key)
        .agg(F.sum("walked").alias("walked"), F.sum("held").alias("held"))
        .filter("walked <> held")
    )
