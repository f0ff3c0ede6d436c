"""Named checks over a table, counted in one pass and returned as rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _violations(condition: Column) -> Column:
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def _as_rows(counted: DataFrame, names: Sequence[str]) -> DataFrame:
    """One wide row of violation counts as a (check, passed, violations) row per name."""
    pairs = [item for name in names for item in (F.lit(name), F.col(name).cast("bigint"))]
    stacked = counted.select(F.stack(F.lit(len(names)), *pairs).alias("check_name", "violations"))
    return stacked.select("check_name", (F.col("violations") == 0).alias("passed"), "violations")


def check(
    df: DataFrame,
    every: dict[str, Column] | None = None,
    some: dict[str, Column] | None = None,
    row_count: dict[str, int] | None = None,
) -> DataFrame:
    """Run all checks over one scan.

    ``every`` must hold on each row (null is a violation), ``some`` on at least one, and
    ``row_count`` gives an expected number of rows.
    """
    counts = {name: _violations(cond) for name, cond in (every or {}).items()}
    for name, cond in (some or {}).items():
        counts[name] = F.when(F.count_if(cond) > 0, 0).otherwise(1)
    for name, expected in (row_count or {}).items():
        counts[name] = F.abs(F.count(F.lit(1)) - expected)
    counted = df.agg(*(c.alias(name) for name, c in counts.items()))
    return _as_rows(counted, list(counts))


def unique(df: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """Whether ``key`` is unique; violations are the rows beyond the first of each key."""
    surplus = repeated(df, key).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias(name))
    return _as_rows(surplus, [name])


def unique_number(df: DataFrame, name: str, column: str) -> DataFrame:
    """``unique`` for one integer column, exact, without moving the ids.

    Ids meet as bitmaps of 32,768 numbers, which tasks build before the shuffle: four kilobytes per bitmap and task,
    whatever the number of ids in it. Made for ids that are dealt densely; where under one number in 500 is used,
    ``unique`` moves less.
    """
    number = F.col(column).cast("bigint")
    maps = df.groupBy(F.bitmap_bucket_number(number).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits"), F.count(F.lit(1)).alias("_rows")
    )
    different = F.when(F.col("_bucket").isNull(), 1).otherwise(F.bitmap_count("_bits"))  # a null is an id like any other
    surplus = maps.agg(F.coalesce(F.sum(F.col("_rows") - different), F.lit(0)).alias(name))
    return _as_rows(surplus, [name])


def repeated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def value_set(column: str, expected: Iterable[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Checks that a column holds exactly the expected values: (every, some) for ``check``."""
    values = list(expected)
    every = {f"{column}_known": F.col(column).isin(*values)}
    some = {f"{column}_has_{value}": F.col(column) == value for value in values}
    return every, some


def table_rules(schema: T.StructType, max_length: dict[str, int]) -> dict[str, Column]:
    """The NOT NULL and length limits of a table as row checks."""
    rules = {f"{f.name}_present": F.col(f.name).isNotNull() for f in schema if not f.nullable}
    for name, limit in max_length.items():
        rules[f"{name}_fits"] = F.coalesce(F.length(name) <= limit, F.lit(True))
    return rules


def observed(df: DataFrame, name: str, every: dict[str, Column]) -> DataFrame:
    """The same counts as metrics of a running stream, reported with its progress."""
    return df.observe(name, *(_violations(c).alias(n) for n, c in every.items()))
