"""The test tables in the shapes of the vendor feeds, the outbox, the cursor and the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import schemas
from tallybook.functions.costs import money
from tallybook.functions.text import vendor_time
from tallybook.session import new_table_path

SHARE = T.DecimalType(6, 4)

# Fixed schema of the events table, needed to read it as a stream.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sold(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Line items of one status with their part, supplier and nation."""
    items = table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == status)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # One dimension at a time: Spark knows each table's size and broadcasts those that are small,
    # while it would overrate a join of two of them and shuffle the line items instead.
    return (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )


def _price() -> Column:
    return money(F.col("l_extendedprice"))


def _discounted() -> Column:
    return money(_price() * (F.lit(1).cast(SHARE) - F.col("l_discount").cast(SHARE)))


def _line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def _end() -> Column:
    return F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_quantity").cast("int"))


def _arn(part: Column) -> Column:
    return F.concat(F.lit("arn:aws:ec2:reserved-instances/ri-"), part.cast("string"))


def cur_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open line items as flat cost line items."""
    c = F.col
    reserved = c("l_returnflag") == "R"
    start, end = vendor_time(c("l_shipdate")), vendor_time(_end())
    return _sold(spark, sf_dir, "O").select(
        _line_id().alias("line_item_id"),
        F.concat(start, F.lit("/"), end).alias("time_interval"),
        F.concat(F.lit("payer-"), c("n_regionkey").cast("string")).alias("payer_account_id"),
        c("l_suppkey").cast("string").alias("usage_account_id"),
        F.when(reserved, "DiscountedUsage")
        .when(c("l_returnflag") == "A", "Usage")
        .otherwise("SavingsPlanCoveredUsage")
        .alias("line_item_type"),
        start.alias("usage_start"),
        end.alias("usage_end"),
        c("p_type").alias("product_code"),
        F.concat(F.lit("BoxUsage:"), c("p_name")).alias("usage_type"),
        F.lit("RunInstances").alias("operation"),
        F.concat(F.lit("i-"), c("l_orderkey").cast("string")).alias("resource_id"),
        c("l_quantity").cast(schemas.QUANTITY).alias("usage_amount"),
        F.when(reserved, F.lit(0).cast(schemas.MONEY)).otherwise(_discounted()).alias("unblended_cost"),
        c("p_name").alias("instance_type"),
        F.concat(F.lit("region-"), c("n_regionkey").cast("string")).alias("region"),
        F.when(reserved, "Reserved")
        .when(c("l_returnflag") == "A", "OnDemand")
        .otherwise("SavingsPlan")
        .alias("pricing_term"),
        _price().alias("on_demand_cost"),
        F.when(reserved, _discounted()).alias("reservation_effective_cost"),
        F.when(reserved, _arn(c("l_partkey"))).alias("reservation_arn"),
        c("n_name").alias("tag_team"),
        c("p_brand").alias("tag_cost_center"),
    )


def fees_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reservation fee per part: the hours and cost of all its reserved line items."""
    bought = (
        table(spark, sf_dir, "lineitem")
        .filter("l_returnflag = 'R'")
        .groupBy("l_partkey")
        .agg(
            F.sum(F.col("l_quantity").cast(schemas.QUANTITY)).alias("hours"),
            F.sum(_discounted()).alias("fee"),
        )
    )
    start, end = "1995-01-01T00:00:00Z", "2002-01-01T00:00:00Z"
    known = {
        "line_item_id": F.concat(F.lit("fee-"), F.col("l_partkey").cast("string")),
        "time_interval": F.lit(f"{start}/{end}"),
        "payer_account_id": F.lit("payer"),
        "usage_account_id": F.lit("payer"),
        "line_item_type": F.lit("RIFee"),
        "usage_start": F.lit(start),
        "usage_end": F.lit(end),
        "product_code": F.lit("reservation"),
        "usage_type": F.concat(F.lit("HeavyUsage:"), F.col("l_partkey").cast("string")),
        "usage_amount": F.col("hours").cast(schemas.QUANTITY),
        "unblended_cost": money(F.col("fee")),
        "reservation_arn": _arn(F.col("l_partkey")),
    }
    absent = lambda f: F.lit(None).cast(f.dataType)
    return bought.select(*(known.get(f.name, absent(f)).alias(f.name) for f in schemas.LINE_ITEM))


def gcp_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished line items as nested billing rows."""
    c = F.col
    pair = lambda key, value: F.struct(F.lit(key).alias("key"), value.alias("value"))
    discount = c("l_discount").cast(SHARE)
    committed = discount > F.lit("0.05").cast(SHARE)
    credit = F.struct(
        F.when(committed, "Committed").otherwise("Sustained").alias("name"),
        money(-(_price() * discount)).alias("amount"),
        F.when(committed, "COMMITTED_USAGE_DISCOUNT")
        .otherwise("SUSTAINED_USAGE_DISCOUNT")
        .alias("type"),
    )
    credits = F.when(discount > 0, F.array(credit)).otherwise(F.array().cast(T.ArrayType(schemas.CREDIT)))
    foreign = c("n_regionkey") == 3
    description = (
        F.when(c("p_type") == "PROMO", F.concat(F.lit("Commitment v1: "), c("p_name")))
        .when(c("p_type") == "SMALL", c("p_name"))
        .otherwise(F.concat(c("p_brand"), F.lit(" Instance Core running in Americas")))
    )
    return _sold(spark, sf_dir, "F").select(
        F.concat(F.lit("acct-"), c("n_regionkey").cast("string")).alias("billing_account_id"),
        F.struct(c("p_type").alias("id"), c("p_type").alias("description")).alias("service"),
        F.struct(c("l_partkey").cast("string").alias("id"), description.alias("description")).alias("sku"),
        vendor_time(c("l_shipdate")).alias("usage_start_time"),
        vendor_time(_end()).alias("usage_end_time"),
        F.struct(c("l_suppkey").cast("string").alias("id"), c("s_name").alias("name")).alias("project"),
        F.array(pair("team", c("n_name")), pair("cost_center", c("p_brand"))).alias("labels"),
        _price().alias("cost"),
        F.when(foreign, "EUR").otherwise("USD").alias("currency"),
        F.when(foreign, F.lit("1.08")).otherwise("1").cast(schemas.RATE).alias("currency_conversion_rate"),
        F.struct(
            (c("l_quantity") * 3600).cast(schemas.QUANTITY).alias("amount"),
            F.lit("seconds").alias("unit"),
            c("l_quantity").cast(schemas.MONEY).alias("amount_in_pricing_units"),
            F.lit("hour").alias("pricing_unit"),
        ).alias("usage"),
        credits.alias("credits"),
        F.when(c("l_linenumber") == 7, "adjustment")
        .when(c("l_linenumber") == 6, "tax")
        .when(c("l_linenumber") == 5, "rounding_error")
        .otherwise("regular")
        .alias("cost_type"),
    )


def outbox_of(events: DataFrame, *more: Column) -> DataFrame:
    """Events, from a table or a stream, as outbox rows, with ``more`` columns behind."""
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("aggregate_type"),
        F.col("user_id").cast("string").alias("aggregate_id"),
        F.col("event_type").alias("type"),
        F.col("props").alias("payload"),
        F.col("ts").cast("timestamp").alias("created_at"),
        *more,
    )


def outbox_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox_of(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a stream."""
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def land(rows: DataFrame, number: Column, parts: int, newest_first: bool = False) -> str:
    """A folder with ``rows`` as ``parts`` files by ``number`` (0 to parts - 1), read by streams in written order.

    Files are written one after the other, the highest number first if ``newest_first``.
    """
    path = new_table_path(rows.sparkSession, "landed")
    for k in sorted(range(parts), reverse=newest_first):
        rows.filter(number == k).coalesce(1).write.mode("append").parquet(path)
    return path


def stream_of(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder as a stream of one file per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def landed_stream(
    spark: SparkSession, rows: DataFrame, number: Column, parts: int, newest_first: bool = False
) -> DataFrame:
    return stream_of(spark, land(rows, number, parts, newest_first), rows.schema)


def cursor_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a saved cursor of its source."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        F.col("event_id").cast("string").alias("last_token"),
        F.col("ts").cast("timestamp").alias("updated_at"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A snapshot and later changes that overlap it by ten days.

    Sign-ups belong to another schema; errors are updates, which an outbox never routes.
    """
    events = table(spark, sf_dir, "events")
    named = outbox_of(events).select(
        "*",
        F.when(F.col("type") == "signup", "public").otherwise("ingestion").alias("source_schema"),
        F.lit("outbox_event").alias("source_table"),
    )
    snapshot = named.filter(F.col("created_at") < F.lit("2024-01-20").cast("timestamp"))
    changes = named.filter(F.col("created_at") >= F.lit("2024-01-10").cast("timestamp"))
    return snapshot, changes.withColumn("op", F.when(F.col("type") == "error", "u").otherwise("c"))
