"""Vendor billing feeds as JSON: line items, billing rows and landed feed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tallybook import schemas


#: Vendor text repeats its field names in every row and is some thirty times as large as the tables it comes from.
CODEC = "gzip"
#: Rows of a written file: one task reads it whole, as a packed file can't be split.
FILE_ROWS = 500_000


def landing(df: DataFrame, items: int = 1) -> DataFrameWriter:
    """Writer of packed JSON lines, absent fields left out; ``items`` is how many rows of a feed one of ``df`` holds."""
    most = max(1, FILE_ROWS // items)
    return df.write.options(compression=CODEC, maxRecordsPerFile=most, ignoreNullFields=True)


def _json(spark: SparkSession, path: str, schema, array_file: bool) -> DataFrame:
    # An array file is one task; land feeds as one object per line to read them in parallel.
    return spark.read.schema(schema).option("multiLine", array_file).option("mode", "FAILFAST").json(path)


def readable(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(schemas.TO_READABLE)


def wire_named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(schemas.TO_WIRE)


def read_line_items(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    return readable(_json(spark, path, schemas.LINE_ITEM_WIRE, array_file))


def read_billing_rows(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    return _json(spark, path, schemas.BILLING_ROW, array_file)


def read_line_item_pages(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    return _json(spark, path, schemas.LINE_ITEM_PAGE, array_file)


def read_billing_row_pages(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    return _json(spark, path, schemas.BILLING_ROW_PAGE, array_file)


def parse_pages(values: DataFrame, schema, column: str = "value") -> DataFrame:
    """Page envelopes from JSON text; one malformed page fails the job."""
    parsed = F.from_json(column, schema, {"mode": "FAILFAST"})
    return values.select(parsed.alias("page")).select("page.*")


def explode_pages(pages: DataFrame, items: str) -> DataFrame:
    """One row per item of every page, keeping the page's other fields and the item's place."""
    envelope = [c for c in pages.columns if c != items]
    return pages.select(*envelope, F.posexplode(items).alias("position", "item")).select(
        *envelope, "position", "item.*"
    )


def vendor_json(*columns: Column | str) -> Column:
    """JSON text of the given columns; null fields are left out, empty arrays stay."""
    return F.to_json(F.struct(*columns))


def to_vendor_json(df: DataFrame) -> DataFrame:
    """Line items as one ``value`` column of JSON text under their wire names."""
    wire = wire_named(df.select(*schemas.TO_WIRE))
    return wire.select(vendor_json("*").alias("value"))


def parse_line_items(values: DataFrame, column: str = "value") -> DataFrame:
    parsed = F.from_json(column, schemas.LINE_ITEM_WIRE, {"mode": "FAILFAST"})
    return readable(values.select(parsed.alias("item")).select("item.*"))


def write_line_items(df: DataFrame, path: str) -> None:
    """Write line items as JSON lines under their wire names."""
    landing(wire_named(df.select(*schemas.TO_WIRE))).json(path)


def write_billing_rows(df: DataFrame, path: str) -> None:
    landing(df.select(*schemas.BILLING_ROW.fieldNames())).json(path)


def to_pages(
    paged: DataFrame, page_of: str, place: str, size: int, items: str, token: str, whole: DataFrame | None = None
) -> DataFrame:
    """Page envelopes from rows that carry their page number and place; ``size`` rows at most each.

    The next token is the next offset, absent on the last page: that of ``whole``, if ``paged`` is a range of its pages.
    """
    rest = [c for c in paged.columns if c not in (page_of, place)]
    envelopes = paged.groupBy(page_of).agg(
        F.array_sort(F.collect_list(F.struct(place, F.struct(*rest).alias("item")))).alias("_sorted")
    )
    last = (paged if whole is None else whole).agg(F.max(page_of)).first()[0]
    following = ((F.col(page_of) + 1) * size).cast("string")
    return envelopes.select(
        F.transform("_sorted", lambda entry: entry["item"]).alias(items),
        F.when(F.col(page_of) < F.lit(last), following).alias(token),
    )
