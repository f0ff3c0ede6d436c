"""Spend that follows restated bills: what a delivery changes, not what it leaves, is computed.

A row that is delivered again is its old version taken back and its new version added. The deltas of a delivery, one
row for each group that it touches, are a partition of their own, which a delivery that is taken in again overwrites;
spend is the sum of all deltas.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions import costs

AMOUNTS = ("list_cost", "net_cost", "effective_cost")
DELIVERY = "delivery"


def deltas(before: DataFrame | None, after: DataFrame, keys: Sequence[str], grain: str = "day") -> DataFrame:
    """Row count and base-currency totals that canonical rows ``after`` add to those ``before``, per group touched."""
    signed = after.withColumn("_sign", F.lit(1))
    if before is not None:
        signed = signed.unionByName(before.withColumn("_sign", F.lit(-1)))
    signed = signed.withColumn(grain, F.date_trunc(grain, "usage_start"))
    total = lambda a: F.sum(costs.to_base(F.col(a) * F.col("_sign").cast("decimal(1,0)"), F.col("rate")))
    sums = signed.groupBy(*keys, grain).agg(F.sum("_sign").alias("line_count"), *(total(a).alias(a) for a in AMOUNTS))
    changed = F.col("line_count") != 0
    for a in AMOUNTS:
        changed = changed | (F.coalesce(F.col(a), F.lit(0)) != 0)
    return sums.filter(changed)


def take_in(
    path: str, delivery: str, before: DataFrame | None, after: DataFrame, keys: Sequence[str], grain: str = "day"
) -> None:
    """Add a delivery to the spend table at ``path``; ``before`` are the old versions of its rows and those withdrawn."""
    told = deltas(before, after, keys, grain).withColumn(DELIVERY, F.lit(delivery))
    # in order of time, so that a filter on it skips files
    writer = told.repartitionByRange(grain).sortWithinPartitions(grain).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(DELIVERY).parquet(path)


def spend(spark: SparkSession, path: str, keys: Sequence[str], grain: str = "day") -> DataFrame:
    """Row count and totals of every group that has rows left."""
    held = spark.read.parquet(path).groupBy(*keys, grain).agg(
        F.sum("line_count").alias("line_count"), *(F.round(F.sum(a), 6).alias(a) for a in AMOUNTS)
    )
    return held.filter("line_count > 0")
