"""Byte-level BPE by merge replay over the distinct words of a block of the corpus.

A task takes its documents block by block. The words of a block that the task has not met yet stand in one array
of symbols; an inverted index leads from the rank of a pair to the places where it stands. The ranks are replayed
in order, each once over all words, and after a merge only the touched neighbours are looked up and indexed again.
Ranks, index and words live inside one task, so the work needs no shuffle and its memory is bounded by a block and
``KNOWN_WORDS``, whatever the corpus holds.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import blocks

BLOCK_BYTES = 2 << 20
KNOWN_WORDS = 300_000
_LOADED: dict[str, "Ranks"] = {}


def word_pattern(pattern: str):
    """White space as Unicode defines it, which is what the rank files' own library matches."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class Ranks:
    """A rank file, and the rank of every pair of tokens whose bytes together are a token."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            split = (line.split() for line in lines)
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in split}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it is none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], -1)

    def one_by_one(self, word: bytes) -> list[int]:
        """A word by itself: always the leftmost of the lowest pairs."""
        ids = self.bytes[np.frombuffer(word, np.uint8)]
        while len(ids) > 1:
            ranked = self.of_pairs(ids[:-1], ids[1:])
            if (ranked < 0).all():
                break
            i = int(np.where(ranked < 0, np.iinfo(np.int64).max, ranked).argmin())
            ids = np.concatenate([ids[:i], ranked[i : i + 1], ids[i + 2 :]])
        return ids.tolist()

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each."""
        lengths = np.array([len(w) for w in words], np.int64)
        n = int(lengths.sum())
        if not n:
            return np.zeros(0, np.int64), lengths
        symbol = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        after = np.arange(1, n + 1)
        after[np.append(word[1:] != word[:-1], True)] = -1
        before = np.arange(-1, n - 1)
        before[np.append(True, word[1:] != word[:-1])] = -1
        alive = np.ones(n, bool)
        rank = np.full(n, -1)
        odd: set[int] = set()
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def look_up(at: np.ndarray) -> np.ndarray:
            """Ranks the pairs that start at these places, and files them."""
            follow = after[at]
            found = np.where(follow >= 0, self.of_pairs(symbol[at], symbol[np.maximum(follow, 0)]), -1)
            rank[at] = found
            at, found = at[found >= 0], found[found >= 0]
            if len(at):
                order = np.argsort(found, kind="stable")
                at, found = at[order], found[order]
                cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
                for part, value in zip(np.split(at, cuts), found[np.append(0, cuts)].tolist()):
                    if value not in index:
                        index[value] = []
                        heapq.heappush(heap, value)
                    index[value].append(part)
            return found

        look_up(np.flatnonzero(after >= 0))
        while heap:
            now = heapq.heappop(heap)
            parts = index.pop(now)
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
            at = at[alive[at] & (rank[at] == now)]
            if not len(at):
                continue
            if len(at) > 1:  # of overlapping pairs every second one counts, from the left
                linked = np.append(False, after[at[:-1]] == at[1:])
                if linked.any():
                    place = np.arange(len(at))
                    first = np.maximum.accumulate(np.where(linked, 0, place))
                    at = at[(place - first) % 2 == 0]
            gone = after[at]
            follow = after[gone]
            symbol[at] = now
            alive[gone] = False
            rank[gone] = -1
            after[at] = follow
            before[follow[follow >= 0]] = at[follow >= 0]
            left = before[at]
            touched = np.unique(np.concatenate([at, left[left >= 0]]))
            found = look_up(touched)
            if len(found) and found[0] < now and len(at) > 1:
                # a lower pair came up: a word with several places just merged may differ from the one-by-one order
                there = word[at]
                odd.update(there[1:][there[1:] == there[:-1]].tolist())
        counts = np.bincount(word[alive], minlength=len(words))
        ids = symbol[alive]
        if odd:
            split = np.split(ids, np.cumsum(counts)[:-1])
            for w in odd:
                split[w] = np.array(self.one_by_one(words[w]), np.int64)
                counts[w] = len(split[w])
            ids = np.concatenate(split)
        return ids, counts


def load_ranks(path: str) -> Ranks:
    if path not in _LOADED:
        _LOADED[path] = Ranks(path)
    return _LOADED[path]


class Words:
    """Ids of the words met so far."""

    def __init__(self, ranks: Ranks) -> None:
        self.ranks = ranks
        self.forget()

    def forget(self) -> None:
        self.known: defaultdict[str, int] = defaultdict(count().__next__)
        self.ids = np.zeros(0, "<u4")
        self.first = np.zeros(1, np.int64)

    def encode(self, texts: list[str], pattern) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        met = len(self.known)
        number = self.known.__getitem__
        rows = [np.fromiter(map(number, pattern.findall(text)), np.int64) for text in texts]
        if len(self.known) > met:
            fresh = [w.encode() for w in list(self.known)[met:]]
            ids, counts = self.ranks.replay(fresh)
            self.ids = np.concatenate([self.ids, ids.astype("<u4")])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
        numbers = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        starts = self.first[numbers]
        counts = self.first[numbers + 1] - starts
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(starts - (ends - counts), counts)]
        edges = np.append(0, ends)[np.cumsum([0, *(len(r) for r in rows)])]
        return ids, np.diff(edges)


def _binary(data: bytes, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _decoded(tokens: list[bytes], ids: bytes | None) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def encode(documents: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """``doc_id, ids``: the ids of the whole text, each as 4 bytes, little end first.

    With ``decoded`` there is also ``bytes``, what those ids stand for, by the same task. Reads ``doc_id, text``
    only; null and empty texts have no ids, doc_id may be null, repeated rows are encoded each. The path must lead
    to the same rank file on every executor.
    """

    def run(batches):
        ranks = load_ranks(path)
        compiled, words = word_pattern(pattern), Words(ranks)
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK_BYTES):
                here = batch.slice(block.first, block.last - block.first)
                texts = [x or "" for x in here.column(1).to_pylist()]
                ids, counts = words.encode(texts, compiled)
                columns = {"doc_id": here.column(0), "ids": _binary(ids.tobytes(), counts * 4)}
                if decoded:
                    back = [_decoded(ranks.tokens, x) for x in columns["ids"].to_pylist()]
                    columns["bytes"] = pa.array(back, pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary" + ", bytes binary" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, bytes``: the bytes that the ids stand for. Null ids decode to nothing."""

    def run(batches):
        tokens = load_ranks(path).tokens
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                here = batch.slice(k, 512)
                texts = pa.array([_decoded(tokens, x) for x in here.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([here.column(0), here.column(1), texts], ["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, bytes binary")
