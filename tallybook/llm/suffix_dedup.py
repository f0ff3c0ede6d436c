"""Removal of long byte strings that occur earlier in the corpus, by suffix arrays.

1. Anchors. Every 100-byte window has an anchor, the gram of least hash in it. Windows in a row with one anchor form
   a context. Equal windows have equal anchors, so only contexts of one anchor need comparing.
2. Contexts of an anchor that are all equal need no bytes: all but the first are repeated.
3. The other contexts, the edges of what is repeated, are dealt to shards by anchor. Each shard sorts its suffixes by
   Larsson and Sadakane's refinement, takes common prefixes by Kasai's method, and so finds equal windows.
4. An anchor with very many contexts is split into several shards; each pair of them is merged by binary search of
   the one's sorted windows in the other's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybook.llm.common import U64, blocks, mixed, span_hashes, written

LENGTH = 100
GRAM = 16
#: Contexts of a shard, each of at most 2 * LENGTH bytes.
SHARD_CONTEXTS = 16_384
#: Bytes of a text that are taken at once; a longer one is cut into overlapping pieces.
PIECE = 4 << 20
_LAST = (1 << 63) - 1


def _packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place, the first the highest; zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), ">u8", padded.tobytes(), 0, (1,)).astype(U64)


def contexts(data: np.ndarray, at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Contexts of the texts: number of the text, first window, last window, hash of the anchor, hash of the bytes."""
    none = np.zeros(0, np.int64)
    gram = min(GRAM, length)
    span = length - gram + 1
    n = len(data)
    if n < length:
        return none, none, none, none.astype(U64), none.astype(U64)
    eight = _packed(data)
    low = eight[np.minimum(np.arange(n) + gram - 8, n - 1)] if gram >= 8 else eight >> U64(64 - 8 * gram)
    grams = mixed(eight * U64(0x9E3779B97F4A7C15) ^ mixed(low)) if gram >= 8 else mixed(low)
    key = (grams & U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=U64)
    least, width = key, 1
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    starts = n - length + 1
    anchor = (least[:starts] & U64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))[:starts]
    valid = np.arange(starts) + length <= at[text + 1]
    place = np.flatnonzero(valid)
    if not len(place):
        return none, none, none, none.astype(U64), none.astype(U64)
    anchor, text = anchor[place], text[place]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    lo, hi = place[first], place[last]
    return text[first], lo, hi, grams[anchor[first]], span_hashes(data, lo, hi + length)


def _pieces(column: pa.Array, length: int):
    """(first row, offset of the piece in its text, bytes, offsets)."""
    for block in blocks(column):
        if block.last - block.first > 1 or len(block.data) <= PIECE:
            yield block.first, 0, block.data, block.at
            continue
        for start in range(0, len(block.data), PIECE):
            data = block.data[start : start + PIECE + length - 1]
            yield block.first, start, data, np.array([0, len(data)])


_PLACES = "doc long, tie long, lo long, hi long"


def _anchored(rows: DataFrame, length: int) -> DataFrame:
    """The contexts of all texts; of equal ones in a batch only the first, the others come as ``repeated``."""

    def run(batches):
        for batch in batches:
            docs = batch.column(0).fill_null(_LAST).to_numpy()
            ties = batch.column(1).to_numpy()
            parts = []
            for row, offset, data, at in _pieces(batch.column(2), length):
                text, lo, hi, anchor, context = contexts(data, at, length)
                start = at[text] - offset
                parts.append((row + text, lo - start, hi - start, anchor, context))
            if not parts:
                continue
            row, lo, hi, anchor, context = (np.concatenate(x) for x in zip(*parts))
            doc = docs[row]
            order = np.lexsort((lo, doc, context, anchor))
            row, lo, hi, anchor, context, doc = (x[order] for x in (row, lo, hi, anchor, context, doc))
            same = np.append(False, (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])) if len(row) else row > 0
            # at an equal place of rows that share an id nothing is earlier
            if len(row):
                group = np.cumsum(~same) - 1
                head = np.flatnonzero(~same)[group]
                equal = same & (doc == doc[head]) & (lo == lo[head])
            else:
                equal = same
            # what is told already needs no gathering: each such row gets a key of its own
            alone = mixed(mixed(doc.view(U64)) + lo.astype(U64))
            told = same & ~equal
            columns = {
                "key": np.where(told, alone, anchor).view(np.int64), "context": context.view(np.int64), "doc": doc,
                "tie": ties[row], "place": lo * (length + 1) + (hi - lo), "repeated": told,
            }
            for k in range(0, len(row), 100_000):
                cut = {name: pa.array(x[k : k + 100_000]) for name, x in columns.items()}
                yield pa.RecordBatch.from_arrays(list(cut.values()), list(cut))

    return rows.mapInArrow(run, "key long, context long, doc long, tie long, place long, repeated boolean")


def _sorted_out(anchored: DataFrame, length: int) -> DataFrame:
    """Contexts that are repeated as a whole, and those whose anchor has other contexts too (``repeated`` is false)."""
    by_key = Window.partitionBy("key")
    by_context = Window.partitionBy("key", "context")
    seen = anchored.select(
        "*",
        F.min(F.struct("doc", "place")).over(by_context).alias("first"),
        (F.min("context").over(by_key) != F.max("context").over(by_key)).alias("several"),
    )
    later = F.struct("doc", "place") != F.col("first")
    lo = F.expr(f"place div {length + 1}")
    found = seen.select(
        "key", "context", "doc", "tie", lo.alias("lo"), (lo + F.col("place") % (length + 1)).alias("hi"),
        (F.col("repeated") | later).alias("repeated"), "several",
    ).where("repeated OR several")
    # a context that is repeated as a whole is not compared, so its hashes need not be written
    still = lambda name: F.when(~F.col("repeated"), F.col(name))
    return found.select(
        still("key").alias("anchor"), still("context").alias("context"), "doc", "tie", "lo", "hi", "repeated"
    )


# --- one shard


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and the rank of each place.

    Larsson and Sadakane: sorted by eight bytes first, then only the groups still unsorted are refined, each time by
    the rank of the suffix as many bytes further on as are sorted already.
    """
    n = len(data)
    first = _packed(data)
    order = np.argsort(first)
    new = np.append(True, first[order][1:] != first[order][:-1]) if n else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else order
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = head, -1
    sorted_to = 8
    while sorted_to < n:
        alone = new & np.append(new[1:], True)
        unsorted = np.flatnonzero(~alone)
        if not len(unsorted):
            break
        places = order[unsorted]
        follow = rank[np.minimum(places + sorted_to, n)]
        # within a group by what follows; groups stay where they are
        sub = np.argsort(head[unsorted] * (n + 1) + follow + 1)
        places, follow, group = places[sub], follow[sub], head[unsorted]
        order[unsorted] = places
        split = np.append(True, (follow[1:] != follow[:-1]) | (group[1:] != group[:-1]))
        new[unsorted] = split
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = head
        sorted_to *= 2
    return order, rank[:n]


def common_prefixes(data: np.ndarray, order: np.ndarray, rank_of: np.ndarray, cap: int, lane: int = 64) -> np.ndarray:
    """Bytes, up to ``cap``, that each sorted suffix shares with the one ahead of it.

    Kasai: in the order of the text the value drops by one at most from place to place, so it is only ever extended.
    Stretches of the text go side by side.
    """
    n = len(data)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    ahead = np.full(n, -1)
    ahead[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(cap + 1, np.uint8)])
    begin = np.arange(0, n, lane)
    held = np.zeros(len(begin), np.int64)
    for step in range(lane):
        place = begin + step
        live = place < n
        begin, held, place = begin[live], held[live], place[live]
        if not len(place):
            break
        other = ahead[place]
        held = np.maximum(held - 1, 0)
        held[other < 0] = 0
        todo = np.flatnonzero(other >= 0)
        while len(todo):
            h, p, q = held[todo], place[todo], other[todo]
            more = (h < cap) & (np.maximum(p, q) + h < n)
            more &= padded[np.minimum(p + h, n)] == padded[np.minimum(q + h, n)]
            todo = todo[more]
            held[todo] += 1
        out[place] = held
    return out[order]


class Shard:
    """Windows of a shard's contexts, sorted, equal ones as one class."""

    def __init__(self, rows: list[tuple[int, int, bytes]], length: int) -> None:
        """rows: document, first window, bytes of the context."""
        sizes = np.array([len(x[2]) for x in rows], np.int64)
        starts = np.cumsum(sizes) - sizes
        self.data = np.frombuffer(b"".join(x[2] for x in rows), np.uint8)
        counts = sizes - length + 1
        self.row = np.repeat(np.arange(len(rows)), counts)
        inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        place = starts[self.row] + inside
        self.doc = np.array([x[0] for x in rows], np.int64)[self.row]
        self.lo = np.array([x[1] for x in rows], np.int64)[self.row] + inside
        order, rank_of = suffix_array(self.data)
        shared = common_prefixes(self.data, order, rank_of, length)
        window = np.full(len(self.data), -1)
        window[place] = np.arange(len(place))
        number = np.cumsum(shared < length)  # of runs of suffixes with `length` equal bytes
        held = window[order] >= 0
        self.window = window[order][held]
        number = number[held]
        new = np.append(True, number[1:] != number[:-1]) if len(number) else np.zeros(0, bool)
        self.number = np.cumsum(new) - 1
        self.head = place[self.window[np.flatnonzero(new)]]  # a place that shows each class's bytes
        classes = int(self.number[-1]) + 1 if len(self.number) else 0
        first = np.flatnonzero(new)
        self.first_doc, self.first_lo = self.doc[self.window[first]], self.lo[self.window[first]]
        again = np.flatnonzero(np.bincount(self.number, minlength=classes)[self.number] > 1)
        number, window = self.number[again], self.window[again]
        by_first = np.lexsort((self.lo[window], self.doc[window], number))
        lead = by_first[np.append(True, number[1:] != number[:-1])] if len(number) else by_first
        self.first_doc[number[lead]], self.first_lo[number[lead]] = self.doc[window[lead]], self.lo[window[lead]]
        self.length = length

    def later(self, doc: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Windows whose class has an earlier occurrence than they are; doc and lo: of each class."""
        mine_doc, mine_lo = self.doc[self.window], self.lo[self.window]
        d, p = doc[self.number], lo[self.number]
        out = np.zeros(len(self.row), bool)
        out[self.window] = (d < mine_doc) | (d == mine_doc) & (p < mine_lo)
        return out

    def find(self, other: Shard, step: int = 1 << 15) -> np.ndarray:
        """For each class of ``other`` the equal class here, or -1: binary search, many at a time."""
        wanted = np.lib.stride_tricks.sliding_window_view(other.data, self.length)
        mine = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        out = np.full(len(other.head), -1)
        for k in range(0, len(out), step):
            sought = wanted[other.head[k : k + step]]
            lo, hi = np.zeros(len(sought), np.int64), np.full(len(sought), len(self.head))
            while len(todo := np.flatnonzero(lo < hi)):
                mid = (lo[todo] + hi[todo]) // 2
                a, b = mine[self.head[mid]], sought[todo]
                at = (a != b).argmax(axis=1)  # 0 if they are equal
                row = np.arange(len(todo))
                less = a[row, at] < b[row, at]
                lo[todo] = np.where(less, mid + 1, lo[todo])
                hi[todo] = np.where(less, hi[todo], mid)
            inside = np.flatnonzero(lo < len(self.head))
            same = (mine[self.head[lo[inside]]] == sought[inside]).all(axis=1)
            out[k + inside[same]] = lo[inside[same]]
        return out


def _spans(shard: Shard, later: np.ndarray, rows: list) -> list[tuple[int, int, int]]:
    """(row, first, last) of runs of later windows."""
    mark = later & np.append(False, later[:-1]) & np.append(False, shard.row[1:] == shard.row[:-1])
    first = np.flatnonzero(later & ~mark)
    ends = np.flatnonzero(later & ~np.append(mark[1:], False))
    return list(zip(shard.row[first].tolist(), shard.lo[first].tolist(), shard.lo[ends].tolist()))


def _compared(texts: DataFrame, length: int) -> DataFrame:
    """Repeated windows among the contexts ``bucket, low, high, shard, doc, tie, lo, bytes``."""

    def work(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        of = table.column("shard").to_numpy()
        names = ("doc", "tie", "lo", "bytes")
        sides = []
        for shard in dict.fromkeys((low, high)):
            part = table.filter(pa.array(of == shard))
            doc, tie, lo, data = (part.column(name).to_pylist() for name in names)
            if doc:
                sides.append((list(zip(doc, lo, data)), tie))
        found: list[tuple[int, int, int, int]] = []

        def tell(shard, later, rows, ties):
            found.extend((rows[r][0], ties[r], first, last) for r, first, last in _spans(shard, later, rows))

        shards = [Shard(rows, length) for rows, _ in sides]
        if low == high:
            for shard, (rows, ties) in zip(shards, sides):
                tell(shard, shard.later(shard.first_doc, shard.first_lo), rows, ties)
        elif len(shards) == 2:
            one, two = shards
            match = one.find(two)
            for here, there, pair in (
                (two, one, match),
                (one, two, _inverse(match, len(one.head))),
            ):
                doc, lo = np.full(len(pair), _LAST), np.full(len(pair), _LAST)
                hit = pair >= 0
                doc[hit], lo[hit] = there.first_doc[pair[hit]], there.first_lo[pair[hit]]
                rows, ties = sides[shards.index(here)]
                tell(here, here.later(doc, lo), rows, ties)
        columns = list(zip(*found)) if found else [[], [], [], []]
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("doc", "tie", "lo", "hi"), columns)})

    return texts.groupBy("bucket", "low", "high").applyInArrow(work, _PLACES)


def _inverse(match: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, -1)
    hit = np.flatnonzero(match >= 0)
    out[match[hit]] = hit
    return out


def _sharded(edges: DataFrame, shard_contexts: int) -> DataFrame:
    """The contexts to compare with their bucket and each pair of shards that they take part in."""
    sizes = edges.groupBy("anchor").agg(F.count("*").alias("size"))
    sizes = sizes.withColumn("shards", F.ceil(F.col("size") / shard_contexts))
    dealt = edges.join(sizes, "anchor")
    total = edges.count()
    buckets = max(1, -(-2 * total // shard_contexts))
    hot = F.col("shards") > 1
    dealt = dealt.withColumn("shard", F.when(hot, F.pmod(F.xxhash64("context"), F.col("shards"))).otherwise(F.lit(0)))
    bucket = F.when(hot, F.concat(F.lit("a"), F.col("anchor").cast("string"))).otherwise(
        F.concat(F.lit("b"), F.pmod(F.xxhash64("anchor"), F.lit(buckets)).cast("string"))
    )
    dealt = dealt.withColumn("bucket", bucket).withColumn("with", F.explode(F.expr("sequence(0L, shards - 1)")))
    return dealt.select(
        "bucket", F.least("shard", "with").alias("low"), F.greatest("shard", "with").alias("high"),
        "shard", "doc", "tie", "lo", "hi",
    )


def repeated_windows(rows: DataFrame, length: int = LENGTH, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """``doc, tie, lo, hi``: first and last start of windows that occur earlier, in ``doc, tie, text``."""
    told = written(_sorted_out(_anchored(rows, length), length), "contexts")
    whole = told.where("repeated").select("doc", "tie", "lo", "hi")
    edges = told.where("NOT repeated").select("anchor", "context", "doc", "tie", "lo", "hi")
    dealt = _sharded(edges, shard_contexts)
    wanted = dealt.groupBy("doc", "tie").agg(
        F.collect_list(F.struct("bucket", "low", "high", "shard", "lo", "hi")).alias("cuts")
    )
    key = F.coalesce("doc", F.lit(_LAST)).alias("doc")
    texts = rows.select(key, "tie", "text").join(wanted, ["doc", "tie"])

    def cut(batches):
        for batch in batches:
            doc, tie, text, cuts = (batch.column(k).to_pylist() for k in range(4))
            for i in range(batch.num_rows):
                data = text[i].encode()
                for k in range(0, len(cuts[i]), 4096):
                    some = cuts[i][k : k + 4096]
                    yield pa.RecordBatch.from_pydict(
                        {
                            **{name: [c[name] for c in some] for name in ("bucket", "low", "high", "shard")},
                            "doc": [doc[i]] * len(some),
                            "tie": [tie[i]] * len(some),
                            "lo": [c["lo"] for c in some],
                            "bytes": [data[c["lo"] : c["hi"] + length] for c in some],
                        }
                    )

    found = texts.select("doc", "tie", "text", "cuts").mapInArrow(
        cut, "bucket string, low long, high long, shard long, doc long, tie long, lo long, bytes binary"
    )
    return whole.unionByName(_compared(found, length))


def remove_repeats(documents: DataFrame, length: int = LENGTH, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row; ``kept`` is what is left, as bytes.

    Reads ``doc_id, text`` only. A byte goes if a string of ``length`` bytes around it also starts earlier: in a
    smaller doc_id, or further ahead in the same one. All is judged on the input; nothing crosses documents. Null
    text is empty. Rows without doc_id come behind all others and count as one document, as do rows that share a
    doc_id: equal places of theirs don't remove each other.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc"), F.crc32(text.cast("binary")).alias("tie"), text.alias("text")
    )
    found = repeated_windows(rows, length, shard_contexts)
    spans = found.groupBy("doc", "tie").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = rows.withColumn("key", F.coalesce("doc", F.lit(_LAST))).join(
        spans.select(F.col("doc").alias("key"), "tie", "spans"), ["key", "tie"], "left"
    )

    def cut(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                yield pa.RecordBatch.from_pydict(_cut(batch.slice(k, 512), length), schema)

    fields = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.binary()}
    schema = pa.schema(list(fields.items()))
    return joined.select("doc", "text", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def _cut(batch: pa.RecordBatch, length: int) -> dict[str, list]:
    out: dict[str, list] = {"doc_id": batch.column(0).to_pylist(), "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
    for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        data = text.encode()
        removed, runs, parts, end, kept_to = 0, 0, [], -1, 0
        for lo, hi in sorted((s["lo"], s["hi"] + length) for s in spans or ()):
            if lo > end:
                runs += 1
                parts.append(data[kept_to:lo])
                removed += hi - lo
                end = kept_to = hi
            elif hi > end:
                removed += hi - end
                end = kept_to = hi
        parts.append(data[kept_to:])
        out["n_bytes"].append(len(data))
        out["n_removed"].append(removed)
        out["n_spans"].append(runs)
        out["kept"].append(b"".join(parts))
    return out
