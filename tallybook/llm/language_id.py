"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of -1 and 1; a letter trigram is bound as the product of its letters'
vectors, rotated by their place. A text is the sum of its trigrams, a language the sum of its learning texts, and
a text is given to the language whose vector has the highest cosine with its own.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import Block, blocks

DIMENSIONS = 512
#: Letters below this code point have a vector of their own, others share those left, by code point.
OWN_LETTERS = 0x530
SLOTS = 4096
#: Distinct trigrams whose vectors are held at once.
SLICE = 20_000
_BITS = 12


@functools.cache
def letter_slots() -> np.ndarray:
    """Slot of each code point's lower-case letter; 0 for all that is no letter."""
    slots = np.zeros(0x110000, np.uint16)
    for point in range(0x110000):
        letter = chr(point)
        if unicodedata.category(letter)[0] == "L":
            low = ord(letter.lower()[0])
            slots[point] = low if low < OWN_LETTERS else OWN_LETTERS + low % (SLOTS - OWN_LETTERS)
    return slots


@functools.cache
def letter_vectors() -> np.ndarray:
    """The letters' vectors, unrotated, rotated by one and by two places."""
    plain = np.random.default_rng(20240229).integers(0, 2, (SLOTS, DIMENSIONS), np.int8) * 2 - 1
    return np.stack([plain, np.roll(plain, 1, axis=1), np.roll(plain, 2, axis=1)])


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    plain, once, twice = letter_vectors()
    mask = SLOTS - 1
    return twice[grams >> 2 * _BITS] * once[grams >> _BITS & mask] * plain[grams & mask]


def gram_counts(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of each text: number of the text, trigram, count. What is no letter becomes one space."""
    points = np.frombuffer(block.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=lead[1:])
    at = lead[block.at]
    slots = np.insert(letter_slots()[points].astype(np.int64), at[:-1], 0)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at) + 1)
    held = (slots != 0) | np.append(True, slots[:-1] != 0) | np.append(True, owner[1:] != owner[:-1])
    slots, owner = slots[held], owner[held]
    # a space at the end of the text closes its last letter
    last = np.append(owner[1:] != owner[:-1], True) & (slots != 0)
    ends = np.flatnonzero(last) + 1
    slots, owner = np.insert(slots, ends, 0), np.insert(owner, ends, owner[ends - 1])
    if len(slots) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = slots[:-2] << 2 * _BITS | slots[1:-1] << _BITS | slots[2:]
    keys = np.sort((owner[:-2] << 3 * _BITS | grams)[owner[:-2] == owner[2:]])
    if not len(keys):
        return keys, keys, keys
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return keys >> 3 * _BITS, keys & ((1 << 3 * _BITS) - 1), counts


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def learn(documents: DataFrame) -> dict[str, np.ndarray]:
    """Vector of each language, summed over the texts of ``lang, text``; rows that lack either are left out.

    Tasks send one vector a language, whatever they read.
    """

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1)):
                own, grams, counts = gram_counts(block)
                if not len(own):
                    continue
                names, lang = np.unique(langs[block.first : block.last].astype(str), return_inverse=True)
                distinct, place = np.unique(grams, return_inverse=True)
                size = len(names) * len(distinct)
                table = np.bincount(lang[own] * len(distinct) + place, counts, size).reshape(len(names), -1)
                for k in range(0, len(distinct), SLICE):
                    bound = gram_vectors(distinct[k : k + SLICE]).astype(float)
                    for name, vector in zip(names.tolist(), table[:, k : k + SLICE] @ bound):
                        sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "vector": [v.tolist() for v in sums.values()]})

    rows = documents.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.col("text").cast("string"))
    parts = rows.mapInArrow(run, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("place", "value")).groupBy("lang", "place")
    vectors: dict[str, np.ndarray] = {}
    for row in sums.agg(F.sum("value").alias("value")).collect():  # one row for each language and dimension
        vectors.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["place"]] = row["value"]
    return vectors


def identify(documents: DataFrame, vectors: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id, lang_pred, score``: the nearest language and its cosine, at least 0.

    Reads ``doc_id, text`` only. A null text or one without a letter is ``und`` with score 0, as is every text if
    no language was learned. Equal cosines go to the first name. Repeated rows are judged each.
    """
    names = sorted(vectors)
    profiles = np.array([vectors[n] / max(np.linalg.norm(vectors[n]), 1e-9) for n in names], np.float32)

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                n = block.last - block.first
                own, grams, counts = gram_counts(block)
                best, score = np.full(n, -1), np.zeros(n)
                if len(own) and names:
                    distinct, place = np.unique(grams, return_inverse=True)
                    texts, row = np.unique(own, return_inverse=True)
                    bundled = np.zeros((len(texts), DIMENSIONS))
                    for m in range(0, len(distinct), SLICE):
                        bound = gram_vectors(distinct[m : m + SLICE]).astype(np.float32)
                        some = (place >= m) & (place < m + SLICE)
                        for k in range(0, len(texts), 512):
                            here = some & (row >= k) & (row < k + 512)
                            table = np.zeros((min(512, len(texts) - k), len(bound)), np.float32)
                            table[row[here] - k, place[here] - m] = counts[here]
                            bundled[k : k + 512] += table @ bound
                    cosines = bundled @ profiles.T
                    cosines /= np.maximum(np.linalg.norm(bundled, axis=1), 1e-9)[:, None]
                    best[texts] = cosines.argmax(axis=1)
                    score[texts] = np.clip(cosines.max(axis=1), 0, 1)
                ids = batch.column(0).slice(block.first, n)
                found = pa.array([names[i] if i >= 0 else "und" for i in best.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([ids, found, pa.array(score)], ["doc_id", "lang_pred", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out_languages(documents: DataFrame) -> DataFrame:
    """Learns from the folds 0 and 2 and judges every row; a row without doc_id is in no fold and not learned."""
    fold = fold_of(F.col("doc_id"))
    vectors = learn(documents.where(fold != 1).select("lang", "text"))
    found = identify(documents, vectors)
    return found.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
