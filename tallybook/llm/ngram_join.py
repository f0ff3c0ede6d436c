"""Near-duplicate documents: a Jaccard join of word shingles with adaptive multi-match prefixes.

Each document's prefix is lengthened by its estimated candidate cost; the longer it is, the more of its tokens a
partner must share before the pair is verified. See ``set_join`` for the steps.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import set_join
from tallybook.llm.common import blocks, shingles

WIDTH, PERCENT = 5, 75


def document_sets(width: int = WIDTH) -> set_join.Sets:
    """The documents' shingles; a document's part is the checksum of its text, which tells rows of one id apart."""

    def sets(batch: pa.RecordBatch):
        for block in blocks(batch.column(1)):
            tokens, owner = shingles(block.data, block.at, width, whole=True)
            rows = np.arange(block.first, block.last)
            cuts = zip(block.at[:-1].tolist(), block.at[1:].tolist())
            yield rows, np.array([zlib.crc32(block.data[a:b]) for a, b in cuts], np.int64), owner, tokens

    return sets


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _joined(documents: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Items, and for each set its component's ``root`` and the rows that the set's rows link with."""
    found, linked = set_join.similar(_rows(documents), document_sets(width), percent, True, "ngram")
    edges = linked.select(F.col("set_id").alias("a"), F.explode("others").alias("b"))
    roots = set_join.components(edges, "ngram-components").withColumnRenamed("node", "set_id")
    counts = linked.groupBy("set_id").agg(F.sum("n_links").alias("n_links"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "part")).alias("first")
    per_set = found.where("n > 0").groupBy("set_id").agg(first, F.count("*").alias("copies"))
    per_set = per_set.join(roots, "set_id", "left").join(counts, "set_id", "left")
    return found, per_set.select(
        "set_id", "first", F.coalesce("root", "set_id").alias("root"),
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )


def near_duplicates(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row.

    Reads ``doc_id, text`` only. Two documents link when their shingles' Jaccard is ``percent`` or more; n_links
    counts the other rows that a row links with, copies included. A null or empty text links with nothing and is
    its own component. Rows without doc_id take part, but no component is named by them: a component of such rows
    alone has a null id. Repeated rows are copies of each other.
    """
    found, per_set = _joined(documents, width, percent)
    named = per_set.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    per_set = per_set.join(named, "root").select("set_id", "component_id", "n_links")
    some = found.where("n > 0").join(per_set, "set_id")
    none = found.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("n_links", F.lit(0).cast("long"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links"]
    return some.select(columns).unionByName(none.select(columns))


def representatives(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that of the smallest doc_id, with all its columns.

    Rows without a word stay, each by itself, unless they repeat each other. Of repeated rows one stays; a row
    without doc_id stays only if no row of its component has one.
    """
    found, per_set = _joined(documents, width, percent)
    heads = per_set.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.part")
    heads = heads.union(found.where("n = 0").select("doc_id", "part").distinct()).toDF("__id", "__part")
    key = documents["doc_id"].cast("long").eqNullSafe(F.col("__id"))
    text = F.crc32(F.coalesce(documents["text"], F.lit("")).cast("binary"))
    joined = documents.join(heads, key & (text == F.col("__part")))
    joined = joined.dropDuplicates(["__id", "__part"])
    return joined.select(*[documents[c] for c in documents.columns])
