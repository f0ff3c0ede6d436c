"""Line deduplication: an exact set-similarity join of lines, which removes the later of two matching lines.

A line's tokens are its distinct five-word shingles, ordered by rarity; a shorter line has all its words as its one
token. Prefix, position and length filters leave the pairs to verify. See ``set_join`` for the steps.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm import set_join
from tallybook.llm.common import blocks, runs, shingles

WIDTH, PERCENT = 5, 75


def line_sets(width: int = WIDTH, whole: bool = True) -> set_join.Sets:
    """The lines with a word; those of under ``width`` words with all of them as their token, or not if not ``whole``.

    A line's part holds its number in the text, from 0, above the text's checksum, which tells rows of one id apart.
    """

    def sets(batch: pa.RecordBatch):
        for block in blocks(batch.column(1)):
            starts, ends, text = runs(block.data != 0x0A, block.at)
            feeds = np.flatnonzero(block.data == 0x0A)
            number = np.searchsorted(feeds, starts) - np.searchsorted(feeds, block.at)[text]
            # each line as a text of its own: from its start to the next one's, the feed between is no word
            at = np.append(starts, len(block.data))
            if len(starts) and starts[0] > 0:
                at, number, text = np.insert(at, 0, 0), np.insert(number, 0, 0), np.insert(text, 0, 0)
            if not len(starts):
                continue
            tokens, owner = shingles(block.data, at, width, whole)
            held, owner = np.unique(owner, return_inverse=True)
            cuts = zip(block.at[:-1].tolist(), block.at[1:].tolist())
            checks = np.array([zlib.crc32(block.data[a:b]) for a, b in cuts], np.int64)
            yield block.first + text[held], number[held] << 32 | checks[text[held]], owner, tokens

    return sets


def wanted_lines(texts: pa.Array, parts: pa.Array) -> pa.Array:
    """The texts with those of their lines only that ``parts`` number."""
    out = []
    for text, own in zip(texts.to_pylist(), parts.to_pylist()):
        lines = text.split("\n")
        out.append("\n".join(lines[part >> 32] for part in own if part >> 32 < len(lines)))
    return pa.array(out, texts.type)


def repeated_lines(
    documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, whole: bool = True
) -> DataFrame:
    """``doc_id, line, checksum`` of each line with an earlier match, the checksum being that of the row's text.

    Earlier is a line of a smaller doc_id, or further ahead under the same one; rows without doc_id come last and
    count as one document, as do rows that share an id, of which equal lines at equal places don't remove each
    other. Lines of under ``width`` words match those of the same words, or none if not ``whole``; lines without a
    word never match. All is judged on the input, so a line goes also if the earlier one goes.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found, linked = set_join.similar(rows, line_sets(width, whole), percent, False, "lines", wanted_lines)
    line = F.shiftright("part", 32)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", line.alias("line"))
    earliest = linked.groupBy("set_id").agg(F.min(place).alias("linked"))
    first = found.groupBy("set_id").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    first = first.join(earliest.hint("shuffle_hash"), "set_id", "left").where("copies > 1 OR linked < first")
    first = first.select("set_id", F.least("first", "linked").alias("least"))
    gone = found.join(first.hint("shuffle_hash"), "set_id").where(place > F.col("least"))
    return gone.select("doc_id", line.alias("line"), F.col("part").bitwiseAND(0xFFFFFFFF).alias("checksum"))


def without_repeated_lines(
    documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, whole: bool = True
) -> DataFrame:
    """The rows with the repeated lines cut from ``text``, other columns untouched.

    A text that loses no line keeps every byte; a null text stays null, one that loses all its lines is empty.
    """
    gone = repeated_lines(documents, width, percent, whole).groupBy("doc_id", "checksum").agg(F.collect_set("line").alias("gone"))
    checksum = F.crc32(documents["text"].cast("string").cast("binary"))
    key = documents["doc_id"].cast("long").eqNullSafe(gone["doc_id"]) & (checksum == gone["checksum"])
    joined = documents.join(gone.hint("shuffle_hash"), key, "left").select(*[documents[c] for c in documents.columns], gone["gone"])
    joined = joined.toDF(*[f"c{k}" for k in range(len(documents.columns))], "gone")  # names may clash
    place = documents.columns.index("text")

    def cut(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                here = batch.slice(k, 512)
                *columns, lost = here.columns
                loses = lost.is_valid()
                texts = columns[place].filter(loses).to_pylist()
                for i, parts in enumerate(lost.filter(loses).to_pylist()):
                    away = set(parts)
                    texts[i] = "\n".join(x for n, x in enumerate(texts[i].split("\n")) if n not in away)
                columns[place] = pc.replace_with_mask(columns[place], loses, pa.array(texts, columns[place].type))
                yield pa.RecordBatch.from_arrays(columns, here.schema.names[:-1])

    kept = T.StructType([T.StructField(f"c{k}", x.dataType) for k, x in enumerate(documents.schema)])
    return joined.mapInArrow(cut, kept).toDF(*documents.columns)
