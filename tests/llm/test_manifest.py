"""SimHash links, the Merkle manifest and the centroid clusters against plain Python over small tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tallybook.llm import clustering, merkle, simhash
from tests.llm import cases


def fingerprint(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = cases.WORD.findall(folded)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_rows(rows):
    prints = [fingerprint(t) for _, t in rows]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            x = prints[todo.pop()]
            for j, y in enumerate(prints):
                if j not in seen and (x ^ y).bit_count() <= 3:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, prints[i], min(ids) if ids else None))
    return out


def order(row):
    return tuple((x is None, 0 if x is None else x) for x in row)


@pytest.mark.parametrize("free_bits", [simhash.FREE_BITS, 2])
def test_simhash(spark, free_bits):
    """At two free bits, buckets of over four fingerprints are dealt again."""
    rows = cases.documents()
    found = simhash.near_duplicates(cases.frame(spark), free_bits=free_bits).collect()
    assert sorted((order((i, f & (1 << 64) - 1, c)) for i, f, c in found)) == sorted(map(order, simhash_rows(rows)))


def test_simhash_without_rows_or_words(spark):
    assert simhash.near_duplicates(cases.frame(spark, []).limit(0)).count() == 0
    rows = [(4, None), (3, ""), (None, " \n"), (9, "one"), (8, "ONE"), (None, "alone here"), (None, None)]
    found = {(r["doc_id"], r["fingerprint"] == 0, r["component_id"]) for r in simhash.near_duplicates(cases.frame(spark, rows)).collect()}
    assert found == {(4, True, 3), (3, True, 3), (None, True, 3), (9, False, 8), (8, False, 8), (None, False, None)}


def test_a_long_text_in_pieces():
    texts = [cases.prose(3, 900), "x" * 400 + " " + cases.prose(4, 50), "one two", "  word\n" * 40, "à" * 999, ""]
    for text in texts:
        for limit in (3, 50, 1000):
            assert simhash.text_fingerprints(pa.array([text, None]), limit=limit).tolist() == [fingerprint(text), 0]


def test_hashes_of_spans():
    own = random.Random(3)
    data = np.frombuffer(own.randbytes(3000), np.uint8)
    starts = np.array([own.randrange(2900) for _ in range(2000)])
    ends = starts + np.array([own.randrange(100) for _ in range(2000)])
    wanted = [xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(starts, ends)]
    assert simhash.span_xxh64(data, starts, ends).tolist() == wanted


def near_values(seed, n):
    own = random.Random(seed)
    values = [own.getrandbits(64) for _ in range(n // 4)] + [0, (1 << 64) - 1]
    while len(values) < n:
        x = own.choice(values)
        for _ in range(own.randrange(5)):
            x ^= 1 << own.randrange(64)
        values.append(x)
    return own.sample(sorted(set(values)), len(set(values)))


def test_trees_find_every_pair_of_their_bucket():
    values = np.array(near_values(7, 600), np.uint64)
    bucket = np.sort(np.arange(len(values)) % 3)
    a, b = simhash.Forest(values, bucket).near(np.arange(len(values)), 3)
    wanted = {
        (i, j)
        for i in range(len(values))
        for j in range(i)
        if bucket[i] == bucket[j] and int(values[i] ^ values[j]).bit_count() <= 3
    }
    assert len(a) == len(wanted) and set(zip(a.tolist(), b.tolist())) == wanted


@pytest.mark.parametrize("free_bits", [12, 5])
def test_linked_values_meet_in_a_bounded_bucket(spark, free_bits):
    values = near_values(8, 400)
    crowd = [7 << 50 | x for x in range(300)]  # they share all but nine bits
    values += [x for x in crowd if x not in set(values)]
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in values]
    nodes = spark.createDataFrame(signed, "node long")
    rows = [(r["mask"], r["value"], r["node"]) for r in simhash.buckets(nodes, 3, free_bits).collect()]
    held: dict[tuple, set] = {}
    for mask, value, node in rows:
        held.setdefault((mask, value), set()).add(node & (1 << 64) - 1)
    assert max(map(len, held.values())) <= 1 << free_bits
    met = {(x, y) for group in held.values() for x in group for y in group}
    for i, x in enumerate(values):
        for y in values[:i]:
            assert (x ^ y).bit_count() > 3 or (x, y) in met


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def run_of(level, i):
    return level[i // 16 * 16 : i // 16 * 16 + 16]


def levels_of(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([digest(*run_of(out[-1], k)) for k in range(0, len(out[-1]), 16)])
    return out


def manifest(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    of = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: levels_of([leaf(r) for r in of[s]]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources])
    out = []
    for s in sources:
        for i, row in enumerate(of[s]):
            own, siblings = leaf(row), []
            struck = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            if struck and row[4] is not None:
                own = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for levels, k in ((trees[s], i), (top, sources.index(s))):
                for level in levels[:-1]:
                    run, at = run_of(level, k), k % 16
                    siblings += run[:at] + run[at + 1 :]
                    own, k = digest(*run[:at], own, *run[at + 1 :]), k // 16
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[s][-1][0], root, digest(*siblings), own, own == root))
    return out


def shown(held):
    return held.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("others")).alias("proof"),
        merkle.folded(F.coalesce("altered", "leaf"), F.col("at"), F.col("others")).alias("folded"),
    ).withColumn("verified", F.col("folded") == F.col("root"))


@pytest.mark.parametrize("block_levels", [3, 1])
def test_manifest(spark, block_levels):
    """At one level a block, trees of three levels are made of blocks of blocks; one source holds most rows."""
    own = random.Random(1)
    rows = [(k, "hot", "en", k % 9, f"Text {k}") for k in range(700)]
    rows += [(1000 + k, f"s{k % 40}", own.choice([None, "de", "fr"]), None, own.choice([None, "", "Ab ß 日本"])) for k in range(140)]
    rows += [(None, None, None, None, None)] * 2 + [(5, None, "", 0, "A"), (5, None, "", 0, "A"), (5, None, "", 0, "B")]
    rows += [(2000 + k, "full", "en", 1, "Z") for k in range(256)] + [(9, "", "x", 1, "Q")]
    own.shuffle(rows)
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    frame = spark.createDataFrame(rows, schema).repartition(7)
    frame = frame.withColumns({name: F.lit("clash") for name in ("tree", "place", "n", "leaf", "block", "digest", "number")})
    found = [tuple(r) for r in shown(merkle.witnesses(frame, block_levels)).collect()]
    assert sorted(found, key=order) == sorted(manifest(rows), key=order)
    assert not all(r[-1] for r in found) and any(r[-1] for r in found)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_manifest_of_few_rows(spark, n):
    rows = [(k, "one", "en", 1, "Abc") for k in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    found = [tuple(r) for r in shown(merkle.witnesses(frame)).collect()]
    assert sorted(found) == sorted(manifest(rows))


def test_witnesses_grow_as_siblings_complete():
    block = merkle.Appender()
    first = block.append(b"0" * 64)
    assert first.parent is None
    for k in range(1, 16):
        block.append(str(k).encode() * 8)
    assert first.at == 0 and first.parent is not None and first.parent.parent is None
    for k in range(16, 256):
        block.append(str(k).encode() * 8)
    assert first.parent.parent is block.close(2)


def clusters(rows, number=8, rounds=10):
    kept = [
        (i, tuple(math.floor(1024 * float(x)) for x in v))
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=name)[:number]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    nearest = lambda v: min((far(v, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == k]
            if mine:
                centroids[k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    told = [(i, *nearest(v)) for i, v in kept]
    inertia: dict[int, int] = {}
    for _, d, k in told:
        inertia[k] = inertia.get(k, 0) + d
    return [(i, k, d, inertia[k], sum(inertia.values()), list(centroids[k])) for i, d, k in told]


def vectors(n):
    own = random.Random(n)
    rows = [(k, [own.gauss(k % 5, 0.3) for _ in range(64)]) for k in range(n)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1])] if n > 5 else []
    broken = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [math.nan] + [1.0] * 63, [math.inf] * 64]
    return rows + [(900 + k, v) for k, v in enumerate(broken)]


@pytest.mark.parametrize("n", [120, 3, 0])
def test_clusters(spark, n):
    rows = vectors(n)
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, vector int")
    found = [(*r[:5], list(r[5])) for r in clustering.clusters(frame.repartition(3)).collect()]
    assert sorted(found, key=lambda r: order(r[:3])) == sorted(clusters(rows), key=lambda r: order(r[:3]))


def test_nearest_by_threshold():
    own = np.random.default_rng(2)
    for k, d in ((8, 64), (300, 3), (1, 5), (40, 1)):
        centroids = own.integers(-20, 20, (k, d))
        centroids[k // 2] = centroids[0]  # a tie goes to the smaller number
        rows = np.concatenate([own.integers(-30, 30, (500, d)), centroids])
        far = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
        who, best, taken = clustering.SortedLists(centroids).nearest(rows)
        assert (who == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
        assert taken < len(rows) * k or k < 40 or d == 1
    assert taken <= len(rows) * 40


def test_a_distance_beyond_63_bits_fails():
    with pytest.raises(ArithmeticError):
        clustering._matrix(pa.array([[1 << 27, 0]]), 2)
