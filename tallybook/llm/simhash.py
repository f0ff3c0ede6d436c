"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through Burkhard-Keller trees.

A fingerprint bit is the majority of that bit over the XXH64 hashes of all three-word shingles, repeats included.
Documents of one fingerprint are one node. Nodes meet in *buckets*: of two nodes that differ in at most r bits, r + 1
groups of bits leave at least one group equal, so every node goes into the bucket of each of its groups' values. A
bucket with more nodes than a tree may hold is dealt again by r + 1 groups of the bits that are still free, until each
bucket is bounded: 2^f nodes at f free bits at most. Each bucket is one shard with a tree of its own. Children hang on
their parent by the integer Hamming distance to it, and a query at distance d follows only the edges d - r to d + r.

All shard trees together hold every node and grow with the corpus, so they are no Spark broadcast: a tree is sent by
shuffle to the task that holds its queries. A bucket gives the edges of a star for each of its components, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import BLOCK_BYTES, LOWER, U64, WHITE, blocks, runs, text_buffers, written
from tallybook.llm.set_join import components, joined_up

WIDTH, RADIUS, SEED = 3, 3, 42
BITS = 64
#: Bits that may be free in a bucket that is not dealt again, whatever it holds; 2 to that power bounds a tree.
FREE_BITS = 12
#: Nodes of one group of work, on average: the trees of many small buckets.
PACK_NODES = 50_000
#: Queries that walk the trees side by side.
WALKERS = 1024
#: Bytes from which a span is hashed by the library rather than side by side with others.
LONG_SPAN = 32

# Fixed values of the XXH64 hash.
_P1, _P2, _P3, _P4, _P5 = (
    U64(0x9E3779B185EBCA87), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x85EBCA77C2B2AE63), U64(0x27D4EB2F165667C5),
)

#: Each bit of a byte as a counter of eight bits.
_SPREAD = np.zeros(256, U64)
for _k in range(8):
    _SPREAD |= ((np.arange(256, dtype=U64) >> U64(_k)) & U64(1)) << U64(8 * _k)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return x << U64(by) | x >> U64(64 - by)


def span_xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each span of bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    four = np.ndarray((len(data) + 1,), "<u4", padded, 0, (1,))
    length = ends - starts
    out = length.astype(U64) + U64(seed) + _P5
    short = np.flatnonzero(length < LONG_SPAN)
    size, at, h = length[short], starts[short].copy(), out[short]
    for k in range(LONG_SPAN // 8 - 1):
        some = np.flatnonzero(size >= 8 * (k + 1))
        word = _rotated(eight[at[some]] * _P2, 31) * _P1
        h[some] = _rotated(h[some] ^ word, 27) * _P1 + _P4
        at[some] += 8
    rest = size & 7
    some = np.flatnonzero(rest >= 4)
    h[some] = _rotated(h[some] ^ (four[at[some]].astype(U64) * _P1), 23) * _P2 + _P3
    at[some] += 4
    rest = rest & 3
    for k in range(3):
        some = np.flatnonzero(rest > k)
        h[some] = _rotated(h[some] ^ (padded[at[some] + k].astype(U64) * _P5), 11) * _P1
    h = (h ^ (h >> U64(33))) * _P2
    h = (h ^ (h >> U64(29))) * _P3
    out[short] = h ^ (h >> U64(32))
    for i in np.flatnonzero(length >= LONG_SPAN).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], seed)
    return out


def _bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How often each bit is set among the hashes from each ``first`` to the next."""
    size = np.diff(np.append(first, len(hashes)))
    parts = -(-size // 255)  # a counter of eight bits holds 255
    part = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    at = np.repeat(first, parts) + 255 * part
    counts = np.empty((len(first), BITS), np.int64)
    for k in range(8):
        lanes = np.add.reduceat(_SPREAD[(hashes >> U64(8 * k)).astype(np.uint8)], at)
        counts[:, 8 * k : 8 * k + 8] = np.add.reduceat(
            lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), np.cumsum(parts) - parts
        )
    return counts


def _joined(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one space after each: bytes, starts, ends, number of the text."""
    ink = ~WHITE[data]
    starts, ends, owner = runs(ink, at)
    length = ends - starts
    out = np.full(int(length.sum()) + len(length), 0x20, np.uint8)
    word = np.repeat(np.arange(len(length)), length)
    out[np.arange(len(word)) + word] = LOWER[data[ink]]
    first = np.cumsum(length + 1) - (length + 1)
    return out, first, first + length, owner


def _votes(data: np.ndarray, at: np.ndarray, width: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: the count of every bit over its shingles, and the number of them."""
    n = len(at) - 1
    counts, total = np.zeros((n, BITS), np.int64), np.zeros(n, np.int64)
    words, first, last, owner = _joined(data, at)
    per_text = np.bincount(owner, minlength=n)
    begin = np.cumsum(per_text) - per_text
    full = np.maximum(per_text - width + 1, 0)
    if whole:
        full[(per_text > 0) & (full == 0)] = 1
    some = np.flatnonzero(full)
    if len(some):
        place = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full)
        head = np.repeat(begin, full) + place
        tail = np.minimum(head + width - 1, np.repeat(begin + per_text - 1, full))
        hashes = span_xxh64(words, first[head], last[tail])
        counts[some] = _bit_counts(hashes, (np.cumsum(full) - full)[some])
        total[some] = full[some]
    return counts, total


def _pieces(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``limit`` bytes that end between words."""
    at = 0
    while at < len(data):
        end = min(at + limit, len(data))
        while end < len(data):
            gap = np.flatnonzero(WHITE[data[end : end + limit]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + limit, len(data))
        yield data[at:end]
        at = end


def _long_votes(data: np.ndarray, width: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """``_votes`` of one text piece by piece; a piece begins with the last words of those before."""
    counts, total, held = np.zeros((1, BITS), np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint8)
    for piece in _pieces(data, limit):
        piece = np.concatenate([held, piece])
        more, n = _votes(piece, np.array([0, len(piece)]), width, False)
        counts, total = counts + more, total + n
        words, first, _, _ = _joined(piece, np.array([0, len(piece)]))
        held = words[first[-(width - 1)] if len(first) >= width - 1 else 0 :] if width > 1 else words[:0]
    return (counts, total) if total[0] else _votes(held, np.array([0, len(held)]), width, True)


def _majority(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    bits = (2 * counts > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def text_fingerprints(column: pa.Array, width: int = WIDTH, limit: int = BLOCK_BYTES) -> np.ndarray:
    """The fingerprint of each text; 0 without words."""
    out = [np.zeros(0, U64)]
    data, at = text_buffers(column)
    long = np.diff(at) > 4 * limit
    for block in blocks(column, limit):
        if long[block.first]:  # such a text is a block of its own
            votes = _long_votes(data[at[block.first] : at[block.first + 1]], width, limit)
        else:
            votes = _votes(block.data, block.at, width, True)
        out.append(_majority(*votes))
    return np.concatenate(out)


def fingerprints(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, fingerprint`` of every row of ``doc_id, text``, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            values = text_fingerprints(batch.column(1), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "fingerprint"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


class Forest:
    """Burkhard-Keller trees of distinct fingerprints, one for each bucket; ``bucket`` ascends."""

    def __init__(self, values: np.ndarray, bucket: np.ndarray):
        self.values = values
        opens = np.append(True, bucket[1:] != bucket[:-1]) if len(bucket) else np.zeros(0, bool)
        root = np.flatnonzero(opens)
        self.root = root[np.cumsum(opens) - 1] if len(bucket) else root
        slots, children = [], []
        left = np.flatnonzero(~opens)
        under = self.root[left]
        while len(left):
            slot = under * (BITS + 1) + np.bitwise_count(values[left] ^ values[under])
            taken, first, place = np.unique(slot, return_index=True, return_inverse=True)
            child = left[first]
            slots.append(taken)
            children.append(child)
            under, rest = child[place], np.ones(len(left), bool)
            rest[first] = False
            left, under = left[rest], under[rest]
        slot = np.concatenate(slots) if slots else np.zeros(0, np.int64)
        order = np.argsort(slot)
        self.slots = slot[order]  # parent and distance in one number
        self.children = (np.concatenate(children) if children else slot)[order]

    def near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the queries and of the nodes of their trees within the radius, each pair from its later place."""
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        query, node = queries, self.root[queries]
        while len(query):
            distance = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
            hit = (distance <= radius) & (node < query)
            found_a.append(query[hit])
            found_b.append(node[hit])
            base = node * (BITS + 1)
            low = np.searchsorted(self.slots, base + np.maximum(distance - radius, 0), "left")
            high = np.searchsorted(self.slots, base + np.minimum(distance + radius, BITS), "right")
            many = high - low
            at = np.arange(int(many.sum())) + np.repeat(low - (np.cumsum(many) - many), many)
            query, node = np.repeat(query, many), self.children[at]
        return np.concatenate(found_a), np.concatenate(found_b)


def star_links(values: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """For every place that is linked within its bucket: the place, and the smallest one that it is connected with."""
    forest = Forest(values, bucket)
    label = np.arange(len(values))
    for k in range(0, len(values), WALKERS):
        joined_up(label, *forest.near(np.arange(k, min(k + WALKERS, len(values))), radius))
    linked = np.flatnonzero(label != np.arange(len(values)))
    return linked, label[linked]


def finer(mask: int, radius: int) -> list[int]:
    """The masks that deal a bucket of ``mask`` again: it, and one of radius + 1 groups of the other bits each."""
    free = [k for k in range(BITS) if not mask >> k & 1]
    cut = [len(free) * k // (radius + 1) for k in range(radius + 2)]
    return [mask | sum(1 << b for b in free[x:y]) for x, y in zip(cut, cut[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def buckets(nodes: DataFrame, radius: int = RADIUS, free_bits: int = FREE_BITS) -> DataFrame:
    """``mask, value, node`` of every bucket that a node of ``node`` belongs to, none of over 2^free_bits nodes."""
    spark = nodes.sparkSession
    masks, done = [0], None
    current = nodes.select("node", F.lit(0).cast("long").alias("mask"))
    while masks:
        split = spark.createDataFrame(
            [(_signed(m), _signed(x)) for m in masks for x in finer(m, radius)], "mask long, to long"
        )
        dealt = current.join(F.broadcast(split), "mask").select("node", F.col("to").alias("mask"))
        dealt = written(dealt.withColumn("value", F.col("node").bitwiseAND(F.col("mask"))), "buckets")
        masks = [m for m in {x for m in masks for x in finer(m, radius)} if BITS - m.bit_count() > free_bits]
        full = dealt.where(F.bit_count("mask") < BITS - free_bits).groupBy("mask", "value").agg(F.count("*").alias("nodes"))
        full = written(full.where(F.col("nodes") > 1 << free_bits).select("mask", "value"), "full-buckets")
        if full.isEmpty():
            masks = []
        here = dealt.join(full, ["mask", "value"], "left_anti") if masks else dealt
        done = here if done is None else done.unionByName(here)
        if masks:
            current = dealt.join(full, ["mask", "value"], "left_semi").select("node", "mask")
    return done.select("mask", "value", "node")


def links(nodes: DataFrame, radius: int = RADIUS, free_bits: int = FREE_BITS) -> DataFrame:
    """``a, b``: edges between fingerprints that connect all within the radius of each other."""
    dealt = buckets(nodes, radius, free_bits)
    packs = dealt.count() // PACK_NODES + 1
    dealt = dealt.withColumn("pack", F.pmod(F.xxhash64("mask", "value"), F.lit(packs)))

    def work(table: pa.Table) -> pa.Table:
        mask, value, node = (table.column(k).to_numpy() for k in ("mask", "value", "node"))
        order = np.lexsort((node, value, mask))
        mask, value, node = mask[order], value[order], node[order]
        new = np.append(True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
        place, root = star_links(node.view(U64), np.cumsum(new), radius)
        return pa.table({"a": pa.array(node[place]), "b": pa.array(node[root])})

    return dealt.groupBy("pack").applyInArrow(work, "a long, b long")


def near_duplicates(
    documents: DataFrame, width: int = WIDTH, radius: int = RADIUS, free_bits: int = FREE_BITS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the smallest doc_id that its links reach, itself included.

    Reads ``doc_id, text`` only. Null and empty texts, and texts without a word, have fingerprint zero and are
    linked like any other; a text of one or two words has its whole sequence as its shingle. Repeated rows and rows
    that share an id come out each. A component whose rows all lack a doc_id has no component_id.
    """
    rows = written(fingerprints(documents, width), "fingerprints")
    nodes = written(
        rows.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("least")), "fingerprint-nodes"
    )
    edges = written(links(nodes.select("node"), radius, free_bits), "fingerprint-links")
    named = nodes.join(components(edges, "fingerprint-components"), "node", "left")
    named = named.select("node", "least", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    told = named.join(least, "root").select(F.col("node").alias("fingerprint"), "component_id")
    return rows.join(told, "fingerprint").select("doc_id", "fingerprint", "component_id")
