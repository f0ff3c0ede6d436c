"""Small tables with every awkward row, and plain Python versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, set_id long, key string, gone string"


def prose(seed: int, words: int) -> str:
    own = random.Random(seed)
    return " ".join("".join(own.choice("abdeiklmnorstu") for _ in range(own.randint(2, 8))) for _ in range(words))


def documents() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    base, passage = prose(1, 120), prose(2, 60)
    rows: list[tuple[int | None, str | None]] = [
        (1, base), (2, base), (7, base.replace(" ", "  ", 1)), (9, base.upper()),
        (3, None), (4, ""), (5, " \n\t "), (6, "one two"), (16, "one two"), (26, "ONE two"),
        (10, prose(3, 80) + "\n" + passage + "\n" + prose(4, 70)), (11, passage + "\n" + prose(5, 90)),
        (12, prose(6, 40) + "\n" + passage), (None, prose(7, 60)), (None, base), (None, None),
        (13, "a" * 500), (14, "a" * 300 + "b" * 250), (15, "ab" * 400), (20, prose(8, 3000)), (20, prose(8, 3000)),
        (21, prose(8, 3000) + " " + prose(9, 30)), (22, "été ß 日本語 𝄞 " * 60), (23, "x\n" * 400),
    ]
    for k in range(30):  # a family of near copies, not all of them linked with each other
        words = base.split()
        own = random.Random(k)
        for _ in range(own.randint(1, 5)):
            words[own.randrange(len(words))] = f"changed{own.randrange(9)}"
        rows.append((100 + k, " ".join(words[:60]) + "\n" + " ".join(words[60:])))
    return rows


def frame(spark, rows=None):
    rows = documents() if rows is None else rows
    return spark.createDataFrame([(i, t, "xx", None, 5, 1, "k", "g") for i, t in rows], SCHEMA).repartition(5)


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def shingles(text, whole):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(folded)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words and whole else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similar(a, b):
    both = len(a & b)
    return bool(a and b) and 100 * both >= 75 * (len(a) + len(b) - both)


def near_duplicates(rows):
    sets = [shingles(t, True) for _, t in rows]
    links = [[j for j in range(len(rows)) if j != i and similar(sets[i], sets[j])] for i in range(len(rows))]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None, len(links[i])))
    return out


def repeated_lines(rows):
    lines = [
        (order(i), k, row, shingles(x, True)) for row, (i, t) in enumerate(rows) for k, x in enumerate((t or "").split("\n"))
    ]
    gone = set()
    for o, k, i, s in lines:
        if any((p, m) < (o, k) and similar(s, z) for p, m, _, z in lines):
            gone.add((i, k))
    return gone


def without_repeated_lines(rows):
    gone = repeated_lines(rows)
    cut = lambda row, t: "\n".join(x for k, x in enumerate(t.split("\n")) if (row, k) not in gone)
    return [(i, t if t is None else cut(row, t)) for row, (i, t) in enumerate(rows)]


PHRASES = (
    "licensed under", "released under", "all rights reserved", "copyright ", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "uses cookies", "javascript", "click here", "sign in", "log in", "subscribe",
)


def line_fails(line):
    words = WORD.findall(line)
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    held = 0
    for phrase in PHRASES:
        for at in range(len(folded)):
            before, after = folded[at - 1 : at] if at else "", folded[at + len(phrase) :][:1]
            if folded.startswith(phrase, at) and not before.isalnum() and (phrase[-1] == " " or not after.isalnum()):
                held += len(phrase.split())
    return (
        5 * sum(not w.strip("|>/\\") for w in words) >= len(words)
        or 10 * sum(c in "#*$%&|<>" for c in line) > sum(map(len, words))
        or 3 * sum(w.endswith("!!") for w in words) > len(words)
        or words[-1][-1] not in ".!?:;\"')]" and len(words) < 8
        or held > 0 and (len(words) <= 20 or 10 * held >= len(words))
    )


def line_verdicts(text):
    """Whether the text is kept, and what is left of it without the lines that fail."""
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts: dict[tuple, int] = {}
    for g in grams:
        counts[g] = counts.get(g, 0) + 1
    twice = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    left = [x for x in (text or "").split("\n") if not WORD.search(x) or not line_fails(x)]
    kept = len(words) >= 50 and 2 * len(twice) <= len(words) and 2 * len(WORD.findall("\n".join(left))) >= len(words)
    return kept, "\n".join(left)


def removed(rows, length):
    first: dict[bytes, tuple] = {}
    texts = [(order(i), i, (t or "").encode()) for i, t in rows]
    for o, _, data in texts:
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            first[s] = min(first.get(s, (o, p)), (o, p))
    out = []
    for o, i, data in texts:
        mark = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < (o, p):
                mark[p : p + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(mark)))
        out.append((i, len(data), sum(mark), runs, bytes(c for c, m in zip(data, mark) if not m)))
    return out
