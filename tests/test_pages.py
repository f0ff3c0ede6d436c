"""Queries that land a feed in pages: what stays on disk, and the same rows whether or not the work is cut in parts."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybook.operators import ordering, paging
from tallybook.plans import queries
from tallybook.session import owned_tables, written_paths

LINES = 900


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Line items of few parts and suppliers, a third of them with an order number that others have too."""
    folder = str(tmp_path_factory.mktemp("tables"))
    at = datetime(2031, 3, 1)
    lines = [
        (k // 3 * 2 if k % 3 else 7, k % 9, k % 4, k % 7 + 1, float(k % 50 + 1), k * 1.25, k % 10 / 100, 0.02, "RAN"[k % 3], "OF"[k // 3 % 2], at + timedelta(days=k % 90))
        for k in range(LINES)
    ]
    made = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "part": ([(k, f"part {k}", f"Brand#{k}", "PROMO" if k % 2 else "SMALL") for k in range(9)], "p_partkey long, p_name string, p_brand string, p_type string"),
        "supplier": ([(k, f"Supplier {k}", k % 2) for k in range(4)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(k, f"NATION_{k}", 3 * k) for k in range(2)], "n_nationkey int, n_name string, n_regionkey int"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def _held(kept):
    """Bytes and kinds of the files of the tables that a query has left."""
    files = [f for path in kept for f in Path(path).rglob("part-*")]
    return sum(f.stat().st_size for f in files), {"".join(f.suffixes[-2:]) for f in files}


def _labels(kept):
    return sorted(Path(path).name.rpartition("-")[0] for path in kept if Path(path).exists())


def _run(spark, tables, name):
    before = len(written_paths())
    rows = sorted(map(str, queries.QUERIES[name](spark, tables).collect()))
    return rows, written_paths()[before:]


def _in_parts(monkeypatch):
    monkeypatch.setattr(ordering, "SLICED_BYTES", 0)
    monkeypatch.setattr(paging, "RANGE_ROWS", 100)


def test_line_item_pages_keep_packed_pages_only(spark, tables, monkeypatch):
    with owned_tables(spark):
        whole, kept = _run(spark, tables, "line_item_pages")
        assert len(whole) == LINES / 2 and _labels(kept) == ["line-item-pages"]
        held, kinds = _held(kept)
        assert kinds == {".json.gz"} and held < 150 * len(whole)  # of about 780 a row as text
        _in_parts(monkeypatch)
        assert _run(spark, tables, "line_item_pages")[0] == whole


def test_billing_row_pages_keep_packed_pages_only(spark, tables, monkeypatch):
    with owned_tables(spark):
        whole, kept = _run(spark, tables, "billing_row_pages")
        assert _labels(kept) == ["billing-row-pages"]
        held, kinds = _held(kept)
        assert kinds == {".json.gz"} and held < 150 * LINES / 2  # of about 670 a row as text
        _in_parts(monkeypatch)
        assert _run(spark, tables, "billing_row_pages")[0] == whole


def test_followed_pages_are_packed_and_their_chunks_go(spark, tables, monkeypatch):
    with owned_tables(spark):
        whole, _ = _run(spark, tables, "line_item_pages")
        _in_parts(monkeypatch)
        followed, kept = _run(spark, tables, "stream_pages")
        assert followed == whole
        assert not {"chunks", "unordered"} & {*_labels(kept)}
        held, kinds = _held([path for path in kept if "/landings-" in path])
        assert kinds == {".json.gz"} and held < 150 * len(whole)


@pytest.mark.parametrize("rows", [0, 1, 7, 20, 21, 1000])
def test_page_ranges_are_the_walk(spark, rows):
    pages = paging.assign_pages(spark.range(50), ["id"], 4)
    ranges = [sorted(map(tuple, part.collect())) for part in paging.page_ranges(pages, 4, rows or None)]
    assert sum(ranges, []) == sorted(map(tuple, pages.collect()), key=lambda r: r[0])
    assert len(ranges) == {0: 1, 1: 13, 7: 13, 20: 3, 21: 3, 1000: 1}[rows]
    assert [list(part.collect()) for part in paging.page_ranges(pages.limit(0), 4)] == [[]]


@pytest.mark.parametrize("order", ["k v", "v k", "k-desc v", "n.a k v", "one v k"])
def test_slices_follow_the_order(spark, monkeypatch, order):
    order = [F.col(x.removesuffix("-desc")).desc() if "-" in x else F.col(x) if "." in x else x for x in order.split()]
    rows = spark.range(3000).select(
        F.when(F.col("id") % 5 > 0, (F.col("id") * 7919 % 101).cast("string")).alias("k"), F.xxhash64("id").alias("v"),
        F.struct((F.col("id") % 3 * 0.5).alias("a")).alias("n"), F.lit("x").alias("one"),
    )
    wanted = rows.orderBy(*order).collect()
    monkeypatch.setattr(ordering, "SLICED_BYTES", 0, raising=False)
    numbered = ordering.global_row_number(rows, order, "number", chunks=7)
    got = sorted(numbered.collect(), key=lambda r: r.number)
    assert [r.number for r in got] == list(range(3000))
    assert [r[:-1] for r in got] == [tuple(r) for r in wanted]


def test_chunks_leave_no_shuffle(spark, monkeypatch):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}

    for sliced in (1 << 60, 0):
        monkeypatch.setattr(ordering, "SLICED_BYTES", sliced, raising=False)
        held = shuffles()
        rows = ordering.chunked(spark.range(5000).repartition(3, "id"), ["id"], 5)
        left = {name for name in shuffles() - held if name.endswith(".data")}
        assert not left and rows.count() == 5000
