"""The deduplicating operators against plain Python over the same rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybook.llm import line_dedup, ngram_join, queries, set_join, suffix_dedup
from tests.llm import cases


def key(row):
    return tuple((x is None, 0 if x is None else x) for x in row)


def same(found, wanted):
    assert sorted(map(key, map(tuple, found))) == sorted(map(key, wanted))


@pytest.mark.parametrize("block_tokens", [set_join.BLOCK_TOKENS, 500])
def test_near_duplicates(spark, monkeypatch, block_tokens):
    monkeypatch.setattr(set_join, "BLOCK_TOKENS", block_tokens)
    found = ngram_join.near_duplicates(cases.frame(spark)).collect()
    same(found, cases.near_duplicates(cases.documents()))


def test_one_row_of_each_component_stays(spark):
    rows = cases.documents()
    kept = ngram_join.representatives(cases.frame(spark))
    assert kept.columns == cases.frame(spark).columns
    told = cases.near_duplicates(rows)
    wanted = {(i, t or "") for (i, t), (_, n, component, _) in zip(rows, told) if n and component == i and i is not None}
    wanted |= {(i, t or "") for (i, t), (_, n, component, _) in zip(rows, told) if n == 0 or component is None}
    found = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    assert len(found) == len(set(found)) and set(found) == wanted


def test_repeated_lines(spark):
    rows = cases.documents()
    found = line_dedup.without_repeated_lines(cases.frame(spark))
    assert found.columns == cases.frame(spark).columns
    same(found.select("doc_id", "text").collect(), cases.without_repeated_lines(rows))


def test_repeated_short_lines(spark):
    rows = [
        (1, "Les.\nAll rights reserved.\nles.\n\n \none two three four"), (2, "All  Rights Reserved.\nLes\n\nLes."),
        (3, None), (4, "one two three four five\none two three\nfour"), (5, "one two three four"), (None, "four\nfive"),
    ]
    found = line_dedup.without_repeated_lines(cases.frame(spark, rows))
    wanted = [
        (1, "Les.\nAll rights reserved.\n\n \none two three four"), (2, "Les\n"), (3, None), (4, rows[3][1]), (5, ""),
        (None, "five"),
    ]
    same(found.select("doc_id", "text").collect(), wanted)


@pytest.mark.parametrize(("length", "shard"), [(100, 16_384), (20, 3), (9, 2)])
def test_repeated_strings(spark, length, shard):
    found = suffix_dedup.remove_repeats(cases.frame(spark), length, shard).collect()
    same(found, cases.removed(cases.documents(), length))


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    rows = [(1, cases.prose(1, 40_000)), (2, cases.prose(1, 40_000)[70_000:] + cases.prose(3, 500)), (3, "ab" * 3000)]
    found = suffix_dedup.remove_repeats(cases.frame(spark, rows)).collect()
    same(found, cases.removed(rows, 100))


def test_empty_tables(spark):
    none = cases.frame(spark, []).limit(0)
    assert ngram_join.near_duplicates(none).count() == 0
    assert ngram_join.representatives(none).count() == 0
    assert line_dedup.without_repeated_lines(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("data", [b"", b"a", b"a" * 700, b"ab" * 300 + b"ba" * 200, random.Random(1).randbytes(3000)])
def test_suffix_array_and_common_prefixes(data):
    values = np.frombuffer(data, np.uint8)
    order, rank = suffix_dedup.suffix_array(values)
    wanted = sorted(range(len(data)), key=lambda i: data[i:])
    assert order.tolist() == wanted
    assert [rank[i] for i in wanted] == list(range(len(data)))
    shared = suffix_dedup.common_prefixes(values, order, rank, 100, lane=64).tolist()
    for k in range(1, len(data)):
        a, b = data[wanted[k - 1] :], data[wanted[k] :]
        both = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == min(both, 100)


def test_binary_search_between_shards():
    own = random.Random(5)
    rows = [(i, 0, bytes(own.choice(b"ab") for _ in range(40))) for i in range(60)]
    one, two = suffix_dedup.Shard(rows[:30], 8), suffix_dedup.Shard(rows[30:], 8)
    shown = lambda s, k: s.data[s.head[k] : s.head[k] + 8].tobytes()
    place = {shown(one, k): k for k in range(len(one.head))}
    assert one.find(two, step=7).tolist() == [place.get(shown(two, k), -1) for k in range(len(two.head))]


@pytest.mark.parametrize("held", [set_join.EDGES_PER_FILE, 3])
def test_components_of_a_chain(spark, monkeypatch, held):
    """At three edges a file, what a task contracts is little and rounds of stars do the rest."""
    monkeypatch.setattr(set_join, "EDGES_PER_FILE", held)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(held, 10_000))
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)], "a long, b long")
    found = {r["node"]: r["root"] for r in set_join.components(edges, "chain").collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_multi_match_level_lengthens_costly_prefixes():
    frequency = np.full(90, 5000)
    level, length = set_join._matches_asked(100, 10, frequency, 75)
    assert level > 1 and length == 100 - 75 + level - 10
    assert set_join._matches_asked(100, 10, np.full(90, 2), 75)[0] <= level



def test_screen_keeps_every_set_with_a_partner(spark):
    """Whatever the batches, and the same when a task runs again."""
    rows = cases.frame(spark).select("doc_id", "text")
    for sets in (ngram_join.document_sets(), line_dedup.line_sets()):
        told = []
        for parts in (1, 1, 7):
            found = set_join.items(rows.repartition(parts, "doc_id"), sets, 75)
            matches = {r["set_id"]: r["matches"] for r in set_join.screened(found).collect()}
            senders = {r["set_id"]: r["n"] for r in found.where("sends").groupBy("set_id").agg(F.count("*").alias("n")).collect()}
            assert all(matches[i] % senders[i] == 0 for i in matches)
            told.append({i: n // senders[i] for i, n in matches.items()})
        assert told[0] == told[1] == told[2] and told[0]
        left = {r["set_id"] for r in set_join.survivors(found, set_join.screened(found), 75).collect()}
        _, linked = set_join.similar(rows, sets, 75, True, "screen-test")
        assert {r["set_id"] for r in linked.collect()} <= left


def test_a_family_is_contracted_to_a_row_a_set(spark, monkeypatch):
    """However many tokens its sets share, and however many tasks read them."""
    told, real = [], set_join.contracted
    monkeypatch.setattr(set_join, "contracted", lambda edges: told.append(real(edges).count()) or real(edges))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    own = [(i, 40, 1, i, 0, [*range(30), *range(1000 + 10 * i, 1010 + 10 * i)], 1, 30) for i in range(200)]
    kind = "set_id long, n long, copies long, doc_id long, part long, tokens array<long>, asks long, prefix long"
    linked = set_join.links(spark.createDataFrame(own, kind), 60, "family-test").collect()
    for name in settings:
        spark.conf.unset(name)
    assert {r["set_id"] for r in linked} == set(range(200)) and all(r["n_links"] == 199 for r in linked)
    assert told[0] == 199


def test_the_joins_of_sets_release_their_shuffles(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for name in ("op1_line_dedup", "op2_ngram_jaccard"):
        spark.conf.unset(key)
        queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert spark.conf.get(key) == "true"
    spark.conf.unset(key)


@pytest.mark.parametrize("bucket_tokens", [set_join.BUCKET_TOKENS, 40])
def test_screen_counts_the_tokens_of_other_sets(spark, monkeypatch, bucket_tokens):
    monkeypatch.setattr(set_join, "BUCKET_TOKENS", bucket_tokens)
    rows = cases.frame(spark).select("doc_id", "text").repartition(5, "doc_id")
    found = set_join.items(rows, line_dedup.line_sets(), 75)
    sent = [(r["set_id"], t) for r in found.where("sends").collect() for t in r["prefix"]]
    owners: dict[int, set] = {}
    for own, token in sent:
        owners.setdefault(token, set()).add(own)
    wanted: dict[int, int] = {}
    for own, token in sent:
        if len(owners[token]) > 1:
            wanted[own] = wanted.get(own, 0) + 1
    assert {r["set_id"]: r["matches"] for r in set_join.screened(found).collect()} == wanted and wanted


def test_a_token_of_many_sets_leaves_a_task_once():
    """Its bucket gets the token alone, and the matches of its sets go by buckets of sets."""
    sets = pa.array(range(3000), pa.int64())
    prefixes = pa.array([[7, 100 + k] for k in range(3000)], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([sets, prefixes], ["set_id", "prefix"])
    rows = pa.Table.from_batches(set_join._bucketed([batch], 3)).to_pylist()
    part = lambda kind, name: [x for r in rows if r["kind"] == kind for x in r[name]]
    assert len(part(set_join.KNOWN, "a")) == 1 and len(part(set_join.OPEN, "a")) == 3000
    assert sorted(part(set_join.SETTLED, "a")) == list(range(3000)) and set(part(set_join.SETTLED, "b")) == {1}
    assert len({r["bucket"] for r in rows if r["kind"] == set_join.SETTLED}) == 8


def test_only_wanted_lines_are_taken_again():
    texts = pa.array(["a\n\nb c\nd\n", "x"])
    got = line_dedup.wanted_lines(texts, pa.array([[2 << 32 | 5, 3 << 32 | 5], [4 << 32, 0]], pa.list_(pa.int64())))
    assert got.to_pylist() == ["b c\nd", "x"]


def test_a_set_of_one_or_two_tokens_has_no_partner():
    assert set_join.has_partners(np.arange(1, 6), 75).tolist() == [False, False, True, True, True]
    assert set_join.has_partners(np.arange(1, 4), 50).tolist() == [True, True, True]
