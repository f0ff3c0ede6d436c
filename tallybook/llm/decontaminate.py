"""Benchmark decontamination by template windows.

Texts become lower-case tokens in which numbers, units behind a number and names inside a sentence are typed
placeholders. Windows of eight tokens are hashed, as templates and word by word, and joined with those of the
benchmark. Along one alignment of a document with an item every value of the item must stand for one value of the
document; only then do its templates count, so a question asked again with other numbers or names is found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import LOWER, U64, Block, blocks, mixed, span_hashes, text_buffers, window_hashes, written

WIDTH = 8
#: Items of fewer tokens are not looked for.
LEAST_TOKENS = 4
#: Tokens of an item, or all it has, that one alignment must cover.
COVERED = 13
#: A template window holds so many words at least that are no placeholder.
PLAIN_WORDS = 5
#: Thinner windows, of so many such words at least, count only where an alignment covers the whole item.
THIN_WORDS = 2
#: Bits of the filter that tasks hold ahead of the join, for each window of the benchmark, and at most: beyond some
#: thirty million windows it lets more through, which the join then leaves out.
BITS_PER_WINDOW = 16
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces lb "
    "lbs pound pounds ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours h day "
    "days week weeks month months year years cent cents dollar dollars euro euros usd eur percent degrees celsius "
    "fahrenheit watt watts volt volts meter meters metre metres kilometer kilometers kilometre kilometres mph kmh"
).split()

_NUMBER, _UNIT, _NAME = mixed(np.array([101, 102, 103], U64))
_LETTER, _DIGIT = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;\n\"")] = True


def _unit_hashes() -> np.ndarray:
    data, at = text_buffers(pa.array(UNITS))
    return span_hashes(data, at[:-1], at[1:])


def _between(mark: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mark) + 1, np.int64)
    np.cumsum(mark, out=total[1:])
    return total[ends] - total[starts]


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: number of the text, hash of the word, hash of the word or its placeholder, is it a slot.

    The last array marks the words that may be names because they open a sentence with a capital letter.
    """
    data, at = block.data, block.at
    n = len(data)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none.astype(U64), none.astype(U64), none.astype(bool), none.astype(bool)
    ahead = np.append(data[1:], 0).astype(np.uint8)
    back = np.append(0, data[:-1]).astype(np.uint8)
    folded = LOWER[data]
    upper2 = (back == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)  # capital letters with marks
    folded[upper2] += 0x20
    kind = _KIND[data]
    digit = kind == _DIGIT
    kind[((data == 0x2E) | (data == 0x2C)) & np.append(False, digit[:-1]) & np.append(digit[1:], False)] = _DIGIT
    mark = np.flatnonzero((data == 0xE2) & ((ahead == 0x80) | (ahead == 0x81)))  # typographic marks and spaces
    for k in range(3):
        kind[np.minimum(mark + k, n - 1)] = 0
    symbol = np.flatnonzero(data == 0xC2)
    kind[symbol] = kind[np.minimum(symbol + 1, n - 1)] = 0
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    change = np.append(True, kind[1:] != kind[:-1]) | edge[:-1]
    starts = np.flatnonzero((kind > 0) & change)
    ends = np.flatnonzero((kind > 0) & np.append(change[1:], True)) + 1
    owner = np.searchsorted(at, starts, "right") - 1
    words = span_hashes(folded, starts, ends)
    if not len(words):
        return owner, words, words, np.zeros(0, bool), np.zeros(0, bool)
    follows = np.append(False, owner[1:] == owner[:-1])
    number = kind[starts] == _DIGIT
    unit = follows & np.append(False, number[:-1]) & ~number
    unit[unit] = np.isin(words[unit], _unit_hashes())
    first, second = data[starts], ahead[starts]
    capital = (first >= 0x41) & (first <= 0x5A) & ~((second >= 0x41) & (second <= 0x5A))
    capital |= (first == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
    stops = np.append(1, _between(_STOP[data], ends[:-1], np.maximum(starts[1:], ends[:-1])))
    name = capital & (ends - starts > 1) & follows & (stops == 0)
    typed = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, words)))
    slot = number | unit | name
    return owner, words, typed, slot, capital & (ends - starts > 1) & ~slot


def windows(block: Block, width: int) -> tuple[np.ndarray, ...]:
    """Windows as (number of the text, place of the first token in the block, is it a template, level, hash, slots).

    Templates of level 0 read a sentence's opening word as it is, those of level 1 as a name; level 2 are thin ones.
    """
    owner, words, typed, slot, opens = tokens(block)
    plain = window_hashes(words, width)
    size = len(plain)
    at = np.arange(size)
    inside = owner[:size] == owner[width - 1 :] if size else np.zeros(0, bool)
    literal = np.flatnonzero(inside)
    found = [(literal, np.zeros(len(literal), np.int64), plain[literal], np.zeros((len(literal), width), bool))]
    for reading in range(2 if size else 0):
        if reading:
            typed, slot = np.where(opens, _NAME, typed), slot | opens
            inside = inside & (_between(opens, at, at + width) > 0)
        slots = _between(slot, at, at + width)
        here = np.flatnonzero(inside & (slots > 0) & (width - slots >= min(THIN_WORDS, width - 1)))
        thin = width - slots[here] < min(PLAIN_WORDS, width - 1)
        key = mixed(window_hashes(typed, width)[here] + U64(1))
        found.append((here, np.where(thin, 2, reading), key, slot[here[:, None] + np.arange(width)]))
    place, level, key, slots = (np.concatenate(x) for x in zip(*found))
    return owner[place], place, np.arange(len(place)) >= len(literal), level, key ^ U64(width), slots, owner, words


_SCHEMA = "id long, place long, template boolean, level long, width long, key long, slots array<long>, size long"


def _held(allowed: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the filter lets a key through; ``allowed`` has eight of its bits a byte."""
    last = U64(8 * len(allowed) - 1)
    out = np.ones(len(key), bool)
    for shift in (0, 34):
        bit = (key >> U64(shift) & last).astype(np.int64)
        out &= (allowed[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
    return out


def _rows(batch, block, width, allowed=None, sizes=None):
    text, place, is_template, level, key, slot, owner, words = windows(block, width)
    if not len(place):
        return None
    held = np.ones(len(place), bool) if allowed is None else _held(allowed, key)
    if sizes is not None:
        held &= sizes[text]
    text, place, is_template, level, key, slot = (x[held] for x in (text, place, is_template, level, key, slot))
    first = np.searchsorted(owner, text, "left")
    size = np.searchsorted(owner, text, "right") - first
    values = words.view(np.int64)
    slots = [
        values[p : p + width][marked].tolist() for p, marked in zip(place.tolist(), slot)
    ]
    ids = batch.column(0).take(pa.array(block.first + text))
    return pa.RecordBatch.from_arrays(
        [
            ids, pa.array(place - first), pa.array(is_template), pa.array(level), pa.array(np.full(len(place), width)),
            pa.array(key.view(np.int64)), pa.array(slots, pa.list_(pa.int64())), pa.array(size),
        ],
        ["id", "place", "template", "level", "width", "key", "slots", "size"],
    )


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """The windows of ``item_id, text``; an item of fewer than eight tokens is one window."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                counts = np.bincount(tokens(block)[0], minlength=block.last - block.first)
                for width in range(LEAST_TOKENS, WIDTH + 1):
                    out = _rows(batch, block, width, sizes=(counts == width) | ((width == WIDTH) & (counts >= WIDTH)))
                    if out is not None and out.num_rows:
                        yield out

    rows = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _SCHEMA)


def _filter(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The filter over the windows' keys, sized by their number, and the widths that occur.

    It is gathered in bitmaps of four kilobytes, 32 megabytes of them at most.
    """
    size = LEAST_BITS
    while size < min(BITS_PER_WINDOW * items.count(), MOST_BITS):
        size *= 2
    probes = F.explode(F.array(F.col("key"), F.shiftrightunsigned("key", 34)))
    bits = items.select(probes.alias("key")).select((F.col("key").bitwiseAND(size - 1) + 1).alias("bit"))
    maps = bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map")
    )
    allowed = np.zeros(size // 8, np.uint8)
    for row in maps.collect():
        held = np.frombuffer(row["map"], np.uint8)
        allowed[(row["bucket"] - 1) * len(held) :][: len(held)] = held
    return allowed, [r[0] for r in items.select("width").distinct().collect()]


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, covered, literal``: each document with each item that it holds.

    Reads ``doc_id, text`` and ``item_id, text`` only. ``covered`` is the largest number of the item's tokens that
    one alignment covers, ``literal`` whether word for word. Null and empty texts hold nothing. Rows without id are
    left out; rows that share a doc_id count as one document, its best alignment is told. Items of under four tokens
    are never found.
    """
    return _found(documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), "text"), benchmark)


def _found(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contaminated`` of rows of ``id, text``."""
    items = written(benchmark_windows(benchmark.where("item_id IS NOT NULL")), "benchmark-windows")
    allowed, widths = _filter(items)

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                for width in widths:
                    out = _rows(batch, block, width, allowed)
                    if out is not None and out.num_rows:
                        yield out

    rows = documents.where("text IS NOT NULL").select("id", F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(run, _SCHEMA).select(
        F.col("id").alias("doc_id"), F.col("place").alias("at"), "template", F.col("level").alias("their_level"), "width", "key", F.col("slots").alias("theirs")
    )
    items = items.withColumnRenamed("id", "item_id")
    met = found.join(items, ["key", "template", "width"])
    met = met.withColumn("level", F.greatest("level", "their_level"))
    places = F.expr("sequence(place, place + width - 1)")
    pairs = F.arrays_zip(F.col("slots").alias("ours"), F.col("theirs").alias("theirs"))
    held = lambda x, of: F.array_distinct(F.flatten(F.collect_set(F.when(of, x))))
    aligned = met.groupBy("doc_id", "item_id", (F.col("at") - F.col("place")).alias("shift")).agg(
        F.max("size").alias("size"),
        F.size(held(places, ~F.col("template"))).alias("plain"),
        *[F.size(held(places, F.col("level") <= k)).alias(f"any{k}") for k in range(3)],
        *[held(pairs, F.col("level") <= k).alias(f"pairs{k}") for k in range(3)],
    )
    need = F.least(F.lit(COVERED), F.col("size"))
    literal = F.col("plain") >= need
    # a level's windows come on top of those below, so none takes away what they show
    one_to_one = [F.size(p) == F.size(F.array_distinct(F.transform(p, lambda x: x["ours"]))) for p in ("pairs0", "pairs1", "pairs2")]
    shown = [one_to_one[k] & (F.col(f"any{k}") >= (F.col("size") if k == 2 else need)) for k in range(3)]
    covered = F.greatest(
        F.when(one_to_one[0], F.col("any0")).otherwise(F.col("plain")), *[F.when(shown[k], F.col(f"any{k}")) for k in (1, 2)]
    )
    good = aligned.where(literal | shown[0] | shown[1] | shown[2])
    return good.groupBy("doc_id", "item_id").agg(
        F.max(covered).cast("long").alias("covered"), F.max(literal).alias("literal")
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no item, with all their columns.

    Each row is judged by its own text, whether or not it has a doc_id or shares it: rows are known by the hash of
    both.
    """
    key = F.xxhash64(documents["doc_id"].cast("long"), documents["text"].cast("string"))
    found = _found(documents.select(key.alias("id"), documents["text"]), benchmark)
    held = found.select(F.col("doc_id").alias("held")).distinct()
    return documents.join(held, key == held["held"], "left_anti")
