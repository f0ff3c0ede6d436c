"""Token counts of whole texts by a sentencepiece model, huge texts in overlapping chunks.

A chunk starts ``overlap`` characters ahead of the last one's end. Within the overlap both encodings are compared
by their token offsets, and spliced at a boundary that is proven stable: the character before it is no space, a
single space follows it, and both encodings have a token boundary there. No piece of the vocabulary holds a space
after another character (checked when the model is loaded), so no merge can cross such a place, whatever
surrounds it. Without such a boundary the overlap is doubled, in the end to the whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HUGE_CHARS = 32_768
OVERLAP_CHARS = 256
_MODELS: dict[str, tuple] = {}


def load_model(path: str):
    """The processor, and the characters each id covers (None if offsets can't be proven from the vocabulary)."""
    if path not in _MODELS:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        widths = np.zeros(model.get_piece_size(), np.int64)
        provable = model.encode("ﬁ  a ", out_type=str) == ["▁", "ﬁ", "▁▁", "a", " "] or (
            "".join(model.encode("ﬁ  a", out_type=str)) == "▁ﬁ▁▁a"
        )
        for i in range(len(widths)):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                widths[i] = (int(piece[3:5], 16) & 0xC0) != 0x80  # a character counts at its first byte
            elif model.is_unknown(i) or model.is_control(i):
                widths[i] = 1 << 40  # offsets can't be told; the sum check then refuses the splice
            else:
                widths[i] = len(piece)
                provable &= "▁" not in piece.lstrip("▁")
        _MODELS[path] = model, widths if provable else None
    return _MODELS[path]


def _encoded(model, widths, text: str) -> tuple[int, np.ndarray] | None:
    """Number of tokens, and where each begins; the space put ahead of a text begins at -1."""
    ids = np.asarray(model.encode(text, num_threads=1), np.int64)
    ends = np.cumsum(widths[ids])
    if not len(ids) or ends[-1] != len(text) + 1:
        return None
    return len(ids), ends - widths[ids] - 1


def count_tokens(path: str, text: str, huge: int = HUGE_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """As the library counts the text as a whole."""
    model, widths = load_model(path)
    if len(text) <= huge or widths is None:
        return len(model.encode(text, num_threads=1))
    total, start, keep_from = 0, 0, -1
    held = _encoded(model, widths, text[:huge])
    end = huge
    while held is not None and end < len(text):
        wide, joined = overlap, None
        while joined is None and wide < end - start:
            begin = end - wide
            step = max(huge, 2 * wide)
            fresh = _encoded(model, widths, text[begin : begin + step])
            if fresh is None:
                break
            ours = held[1] + start
            theirs = fresh[1] + begin
            common = np.intersect1d(ours[ours > begin], theirs[theirs < end])
            for p in common[common > keep_from][::-1].tolist():
                if text[p] == " " and text[p - 1] not in " ▁" and p + 1 < end and text[p + 1] not in " ▁":
                    joined = p, begin, begin + step, fresh
                    break
            wide *= 2
        if joined is None:
            held = None
            break
        p, begin, stop, fresh = joined
        ours = held[1] + start
        total += int(np.count_nonzero((ours < p) & (ours >= keep_from)))
        start, end, held, keep_from = begin, min(stop, len(text)), fresh, p
    if held is None:
        return len(model.encode(text, num_threads=1))
    return total + int(np.count_nonzero(held[1] + start >= keep_from))


def count_documents(documents: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    Reads ``doc_id, text`` only; null text counts as empty, doc_id may be null, repeated rows are counted each.
    The model's path must lead to the same file on every executor.
    """

    def count(batches):
        model, _ = load_model(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            counts = np.zeros(len(texts), np.int64)
            small = [i for i, x in enumerate(texts) if len(x) <= HUGE_CHARS]
            for k in range(0, len(small), 256):
                part = small[k : k + 256]
                counts[part] = [len(x) for x in model.encode([texts[i] for i in part], num_threads=1)]
            for i, x in enumerate(texts):
                if len(x) > HUGE_CHARS:
                    counts[i] = count_tokens(path, x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts)], ["doc_id", "n_tokens"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select(F.struct("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("n")).alias("doc_id"), "text")
    counted = rows.mapInArrow(count, "doc_id struct<doc_id: long, n: int>, n_tokens long")
    return counted.select(
        "doc_id.doc_id",
        F.col("doc_id.n").cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
