"""Line-first quality rules.

Every line of a document is held against a punctuation, a navigation, a symbol and a boilerplate rule. Failing
lines go; a document that loses more than half of its words is rejected, as is one that fails the base rules.
All rules are counts over bytes, taken for a block of texts at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import LOWER, WHITE, Block, blocks, runs, span_hashes, window_hashes

MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
SEPARATORS = b"|>/\\"
ENDS = b".!?:;\"')]"
#: A line without an end mark passes from this many words.
UNENDED_WORDS = 8
#: A line of more words fails by boilerplate only if a tenth of its words are such phrases.
SHORT_WORDS = 20
BOILERPLATE = (
    "licensed under", "released under", "all rights reserved", "copyright ", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "uses cookies", "javascript", "click here", "sign in", "log in", "subscribe",
)


def _marks(chars: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[list(chars)] = True
    return marks


_SYMBOL, _SEPARATOR, _END = _marks(SYMBOLS), _marks(SEPARATORS), _marks(ENDS)


def _lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines that hold a byte: starts, ends, number of the text."""
    return runs(block.data != 0x0A, block.at)


def _sums(mark: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mark) + 1, np.int64)
    np.cumsum(mark, out=total[1:])
    return total[ends] - total[starts]


def _phrase_words(data: np.ndarray, first: np.ndarray, last: np.ndarray, phrases: Sequence[str]) -> np.ndarray:
    """Words of each line that belong to ``phrases``, in lower case; a phrase starts and ends where a word does.

    One that ends with a space is followed by another word of the line.
    """
    held = np.zeros(len(first), np.int64)
    folded = LOWER[data].tobytes()
    for phrase in phrases:
        sought = phrase.encode()
        k = folded.find(sought)
        while k >= 0:
            line, end = int(np.searchsorted(first, k, "right")) - 1, k + len(sought)
            if line >= 0 and end <= last[line]:
                before = folded[max(first[line], k - 4) : k].decode(errors="ignore")[-1:]
                after = folded[end : min(last[line], end + 4)].decode(errors="ignore")[:1]
                if not before.isalnum() and (phrase[-1] == " " or not after.isalnum()):
                    held[line] += len(phrase.split())
            k = folded.find(sought, k + 1)
    return held


def measure(block: Block, boilerplate: Sequence[str] = BOILERPLATE) -> dict[str, np.ndarray]:
    """The base counts and the verdict of each text of a block."""
    return _measured(block, boilerplate)[0]


def _measured(block: Block, boilerplate: Sequence[str]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """What ``measure`` gives, and of each failing line the number of its text and its first byte."""
    data, at = block.data, block.at
    n = len(at) - 1
    ink = ~WHITE[data]
    starts, ends, owner = runs(ink, at)
    per_text = lambda x, weights=None: np.bincount(x, weights, minlength=n).astype(np.int64)
    n_words = per_text(owner)
    lead = (data & 0xC0) != 0x80

    hashes = span_hashes(data, starts, ends)
    grams = window_hashes(hashes, 3)
    inside = np.flatnonzero(owner[: len(grams)] == owner[2:]) if len(grams) else np.zeros(0, np.int64)
    order = inside[np.lexsort((grams[inside], owner[inside]))]
    same = (grams[order][1:] == grams[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = order[np.append(same, False) | np.append(False, same)] if len(order) else order
    repeated = np.zeros(len(owner), bool)
    for k in range(3):
        repeated[twice + k] = True

    first, last, text = _lines(block)
    words_at = np.zeros(len(data) + 1, np.int64)
    mark = np.zeros(len(data), bool)
    mark[starts] = True
    np.cumsum(mark, out=words_at[1:])
    words = words_at[last] - words_at[first]
    held = words > 0
    first, last, text, words = first[held], last[held], text[held], words[held]
    same_line = span_hashes(data, first, last)
    order = np.lexsort((same_line, text))
    copies = (same_line[order][1:] == same_line[order][:-1]) & (text[order][1:] == text[order][:-1])

    bare = _sums(~_SEPARATOR[data], starts, ends) == 0
    shout = (data[ends - 1] == 0x21) & (data[np.maximum(ends - 2, 0)] == 0x21) & (ends - starts > 1)
    word_line = np.searchsorted(first, starts, "right") - 1
    per_line = lambda x: np.bincount(word_line[x], minlength=len(first))
    symbols = _sums(_SYMBOL[data], first, last)
    chars = _sums(lead & ink, first, last)
    final = np.zeros(len(first), np.uint8)
    final[word_line] = data[ends - 1]  # the last word of a line is written last
    failed = (
        (5 * per_line(bare) >= words)
        | (10 * symbols > chars)
        | (3 * per_line(shout) > words)
        | (~_END[final] & (words < UNENDED_WORDS))
    )
    phrases = _phrase_words(data, first, last, boilerplate)
    failed |= (phrases > 0) & ((words <= SHORT_WORDS) | (10 * phrases >= words))
    n_repeat = per_text(owner[repeated])
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words)
    left = per_text(text, np.where(failed, 0, words))
    found = {
        "n_words": n_words,
        "word_chars": _sums(lead & ink, at[:-1], at[1:]),
        "n_symbols": _sums(_SYMBOL[data], at[:-1], at[1:]),
        "n_dup_lines": per_text(text[order][1:][copies]),
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": ~base_failed & (2 * left >= n_words),
        "n_words_left": left,
        "n_lines_removed": per_text(text[failed]),
    }
    return found, text[failed], first[failed]


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_words_left long, n_lines_removed long"
)


def assess(documents: DataFrame, boilerplate: Sequence[str] = BOILERPLATE) -> DataFrame:
    """``doc_id`` and the counts and verdict of every row.

    Reads ``doc_id, text`` only. A null or empty text has no words, fails the base rules and is not kept. doc_id
    may be null; repeated rows are assessed each.
    """

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                found = measure(block, boilerplate)
                ids = batch.column(0).slice(block.first, block.last - block.first)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(x) for x in found.values())], ["doc_id", *found]
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {COLUMNS}")


def keep(documents: DataFrame, boilerplate: Sequence[str] = BOILERPLATE) -> DataFrame:
    """The rows whose text is kept, with all their columns, texts untouched."""
    columns, names = documents.schema, documents.columns
    place = next(i for i, name in enumerate(names) if name == "text")

    def run(batches):
        for batch in batches:
            good = [measure(block, boilerplate)["kept"] for block in blocks(batch.column(place))]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return documents.mapInArrow(run, columns)


def cut_failed_lines(documents: DataFrame, boilerplate: Sequence[str] = BOILERPLATE) -> DataFrame:
    """The rows whose text is kept, with the failing lines cut from it; other columns untouched.

    The lines are those that ``measure`` counts as removed. What is left of a text keeps its bytes and its order, lines
    without a word included.
    """
    columns, names = documents.schema, documents.columns
    place = next(i for i, name in enumerate(names) if name == "text")

    def run(batches):
        for batch in batches:
            good, texts = [], []
            for block in blocks(batch.column(place)):
                found, text, first = _measured(block, boilerplate)
                good.append(found["kept"])
                gone: dict[int, list[int]] = {}
                for i, byte in zip(text.tolist(), first.tolist()):
                    if found["kept"][i]:
                        gone.setdefault(i, []).append(byte - int(block.at[i]))
                held = batch.column(place).slice(block.first, block.last - block.first).to_pylist()
                for i, starts in gone.items():
                    away, at, left = set(starts), 0, []
                    for line in held[i].encode().split(b"\n"):
                        if at not in away or not line:
                            left.append(line)
                        at += len(line) + 1
                    held[i] = b"\n".join(left).decode()
                texts += held
            if good:
                out = [*batch.columns]
                out[place] = pa.array(texts, batch.schema.field(place).type)
                out = pa.RecordBatch.from_arrays(out, schema=batch.schema)
                yield out.filter(pa.array(np.concatenate(good)))

    return documents.mapInArrow(run, columns)
