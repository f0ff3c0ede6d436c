"""Helpers the operators share: reading tables, shared tables, and text as numpy arrays.

A text column arrives in a task as Arrow batches. ``blocks`` cuts a batch into pieces of about a megabyte,
so that the arrays derived from the bytes stay small whatever the batch holds; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tallybook.session import new_table_path

U64 = np.uint64
BLOCK_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = new_table_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def looked_up(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``values[data]`` for bytes and 256 one-byte values, without an index array eight times as large."""
    return np.frombuffer(data.tobytes().translate(values.tobytes()), np.uint8).view(values.dtype)


class Block(NamedTuple):
    """Texts ``first`` to ``last`` of a batch: their bytes, and n + 1 offsets into them."""

    first: int
    last: int
    data: np.ndarray
    at: np.ndarray


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and its n + 1 offsets; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    if not len(column):
        return
    data, at = text_buffers(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield Block(first, last, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes that stay within one text: starts, ends, number of the text."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.repeat(np.arange(len(at) - 1), np.diff(np.searchsorted(starts, at)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = np.ones(1, U64)
_INVERSES = np.ones(1, U64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        with np.errstate(over="ignore"):
            _POWERS = np.concatenate([np.ones(1, U64), np.full(size - 1, _BASE, U64)]).cumprod()
            _INVERSES = np.concatenate([np.ones(1, U64), np.full(size - 1, _BASE_INVERSE, U64)]).cumprod()
    return _POWERS, _INVERSES


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, the same wherever the span stands."""
    powers, inverses = _powers(len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_VALUES[data] * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(U64))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` neighbours, in order."""
    if len(values) < width:
        return np.zeros(0, U64)
    n = len(values) - width + 1
    out = values[:n].copy()
    for k in range(1, width):
        out = out * U64(0x9E3779B97F4A7C15) + values[k : k + n]
    return mixed(out)


_OWNER_BITS = 20


def token_sets(tokens: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each owner, ascending in the owner, then in the token."""
    if not len(tokens):
        return tokens, owner
    order = None
    if owner.max() < 1 << _OWNER_BITS:  # one key, sorted several times faster than two
        key = owner.astype(U64) << U64(64 - _OWNER_BITS) | tokens >> U64(_OWNER_BITS)
        order = np.argsort(key)
        key, sorted_tokens = key[order], tokens[order]
        if ((key[1:] == key[:-1]) & (sorted_tokens[1:] != sorted_tokens[:-1])).any():
            order = None  # the key's bits don't tell all tokens apart
    if order is None:
        order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[new], owner[new]


def shingles(data: np.ndarray, at: np.ndarray, width: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of lower-cased texts, as hashes, with the number of the text.

    A text of fewer words gives its whole sequence as one shingle if ``whole``, else nothing.
    """
    starts, ends, owner = runs(looked_up(data, ~WHITE), at)
    words = span_hashes(looked_up(data, LOWER), starts, ends)
    tokens = window_hashes(words, width)
    inside = owner[: len(tokens)] == owner[width - 1 :] if len(tokens) else np.zeros(0, bool)
    tokens, own = tokens[inside], owner[: len(tokens)][inside]
    if whole and len(words):
        counts = np.bincount(owner, minlength=len(at) - 1)
        short = np.flatnonzero((counts > 0) & (counts < width))
        first = np.cumsum(counts) - counts
        value = np.zeros(len(short), U64)
        for k in range(width - 1):
            more = counts[short] > k
            value[more] = value[more] * U64(0x9E3779B97F4A7C15) + words[first[short[more]] + k]
        tokens = np.concatenate([tokens, mixed(value + counts[short].astype(U64))])
        own = np.concatenate([own, short])
    return token_sets(tokens, own)


def list_array(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """``values``, ascending in the owner, as one list for each of ``n`` owners."""
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(owner, minlength=n), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))
