import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators import ordering, outbox, reconcile


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; one key holds a third of them, one key is null."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((key, rng.randrange(50), i))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, id int").repartition(5).cache()


def test_global_row_number(skewed):
    got = ordering.global_row_number(skewed, ["t", "id"], "n", chunks=7).collect()
    expected = sorted((r.t, r.id) for r in skewed.collect())
    assert [(r.t, r.id) for r in sorted(got, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in got) == list(range(3000))


def _numbers(df, hot_rows):
    numbered = ordering.number_within(df, ["k"], ["t", "id"], "n", hot_rows)
    return sorted(numbered.collect(), key=str)


def test_hot_keys_are_numbered_as_ordinary_ones(skewed):
    usual = _numbers(skewed, 10**9)
    assert _numbers(skewed, 900) == usual
    assert _numbers(skewed, 0) == usual


def test_copies_are_numbered_and_spread_over_chunks(spark, skewed):
    copies = skewed.filter("id % 50 = 0").crossJoin(spark.range(40).select())
    hot = skewed.filter("k = 'hot'").limit(1).crossJoin(spark.range(900).select())
    rows = copies.unionByName(hot)
    usual = _numbers(rows, 10**9)
    assert len(usual) == 60 * 40 + 900
    assert _numbers(rows, 500) == usual
    got = ordering.global_row_number(rows, ["t", "id", "k"], "n", 5).collect()
    assert sorted(r.n for r in got) == list(range(len(usual)))
    assert [(r.t, r.id) for r in sorted(got, key=lambda r: r.n)] == sorted((r.t, r.id) for r in usual)
    one = spark.range(4000).select(F.lit(1).alias("id"))
    sizes = ordering.chunked(one, ["id"], chunks=4).groupBy(ordering.CHUNK).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2500


def test_hot_and_usual_path_agree_on_any_column(spark, skewed):
    signs = spark.createDataFrame([(i, -0.0 if i % 2 else 0.0) for i in range(3000)], "id int, z double")
    value = F.parse_json(F.concat(F.lit('{"a": '), F.col("id").cast("string"), F.lit("}")))
    odd = skewed.join(signs, "id").withColumn("v", value)
    numbers = lambda hot: sorted(
        ordering.number_within(odd, ["k"], ["t", "id"], "n", hot)
        .select("id", "n", F.to_json("v").alias("v"), F.col("z").cast("string").alias("z")).collect()
    )
    assert numbers(500) == numbers(10**9) and {r.z for r in numbers(500)} == {"-0.0", "0.0"}


def test_all_hot_keys_are_found(skewed):
    hot = skewed.select(F.xxhash64(F.lit("hot"))).first()[0]
    assert [r[0] for r in ordering.hot_keys(skewed, ["k"], 900).collect()] == [hot]
    assert ordering.hot_keys(skewed, ["k"], 0).count() == 5


def test_a_hot_key_spans_several_chunks(skewed):
    cut = ordering.chunked(skewed, ["k", "t", "id"], chunks=8)
    spread = cut.filter("k = 'hot'").groupBy(ordering.CHUNK).count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 800


def test_chunks_are_ordered_and_complete(skewed):
    rows = ordering.chunked(skewed, ["t", "id"], chunks=6).collect()
    ranked = sorted(rows, key=lambda r: (r[ordering.CHUNK], r[ordering.PLACE]))
    assert [(r.t, r.id) for r in ranked] == sorted((r.t, r.id) for r in rows)
    assert len(rows) == 3000


def test_first_per_key_drops_copies_before_the_shuffle(skewed):
    first = ordering.first_per_key(skewed, ["k"], ["t", "id"])
    plan = first._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    expected = {}
    for r in skewed.collect():
        best = expected.get(r.k)
        expected[r.k] = min(best, (r.t, r.id)) if best else (r.t, r.id)
    assert {r.k: (r.t, r.id) for r in first.collect()} == expected


def test_dedup_keeps_the_first_by_a_total_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, "q"), (None, 1, "m"), (None, 1, "m")], "id string, at int, v string")
    got = [tuple(r) for r in outbox.dedup(df, ["id"], ["at", "v"]).collect()]
    assert sorted(got, key=str) == [("a", 1, "y"), ("b", 5, "q"), (None, 1, "m"), (None, 1, "m")]


def _trips(spark, seed):
    rng = random.Random(seed)
    start = 1_700_000_000
    ids = ["hot"] * 6 + ["a", "b", None]
    sent = [(rng.choice(ids), start + rng.randrange(400), n) for n in range(450)]
    sent += [sent[0]] * 50
    back = [(rng.choice(ids), start + rng.randrange(400)) for _ in range(120)]
    published = spark.createDataFrame(sent, "id string, t long, n int").select("id", F.timestamp_seconds("t").alias("published_at"), "n")
    consumed = spark.createDataFrame(back, "id string, t long").select("id", F.timestamp_seconds("t").alias("consumed_at"))
    expected = {}
    for key, at, n in sent:
        near = [t for k, t in back if k == key and key is not None and at <= t <= at + 5]
        expected[n] = (min(near) - at) * 1000 if near else None
    return published, consumed, expected


@pytest.mark.parametrize("hot_rows", [10**9, 150, 0])
def test_round_trip_takes_the_first_consumption_in_time(spark, hot_rows):
    published, consumed, expected = _trips(spark, hot_rows % 97)
    got = reconcile.round_trip(published, consumed, ["id"], "5 SECONDS", hot_rows).collect()
    assert {r.n: r.latency_ms for r in got} == expected
    assert all(r.timed_out == (r.latency_ms is None) for r in got) and len(got) == 500
    assert sum(r.n == 0 for r in got) == 51


@pytest.mark.parametrize("hot_rows", [10**9, 900, 0])
def test_sequence_audit_against_a_plain_loop(skewed, hot_rows):
    events = skewed.withColumn("created", F.timestamp_seconds(F.col("t")))
    got = reconcile.sequence_audit(events, "k", "created", "id", None, hot_rows).collect()
    state, expected = {}, {}
    for r in sorted(skewed.collect(), key=lambda r: r.id):
        count, newest = state.get(r.k, (0, None))
        late = newest is not None and r.t < newest
        gap = None if newest is None or late else (r.t - newest) * 1000
        expected[r.id] = (count + 1, late, gap)
        state[r.k] = (count + 1, r.t if newest is None else max(newest, r.t))
    assert {r.id: (r.arrival_no, r.out_of_order, r.gap_ms) for r in got} == expected


def test_shared_folder_is_the_named_one(spark):
    from tallybook.session import new_table_path, written_paths

    path = new_table_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
    assert path in written_paths()


def test_tables_are_cleared_by_their_owner(spark):
    from pathlib import Path

    from tallybook.session import owned_tables, written_paths

    before = written_paths()
    with owned_tables(spark):
        cut = ordering.chunked(spark.range(10), ["id"], 2)
        path = Path(written_paths()[-1])
        assert cut.count() == 10 and path.exists()
    assert not path.exists() and written_paths() == before


def test_rows_equal_in_order_follow_their_content(spark):
    """Whichever task a row comes from: chunks of one input dealt in two ways hold the same rows."""
    rows = spark.range(400).select((F.col("id") % 2).alias("k"), (F.col("id") % 100).alias("v"))
    dealt = [rows.repartition(n, "v") for n in (3, 7)]
    told = [
        sorted((r["_chunk"], r["_place"], r["k"], r["v"]) for r in ordering.chunked(df, ["k"], 5).collect()) for df in dealt
    ]
    content = lambda x: [(k, v) for _, _, k, v in x]
    assert content(told[0]) == content(told[1])
