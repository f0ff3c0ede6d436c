import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.operators import paging
from tallybook.sources import feeds


def test_absent_fields_are_left_out(line_items):
    rows = line_items.orderBy("line_item_id").collect()
    texts = [json.loads(r.value) for r in feeds.to_vendor_json(line_items.orderBy("line_item_id")).collect()]
    assert [len(t) for t in texts] == [sum(v is not None for v in r) for r in rows]
    tax = next(t for t in texts if t["lineItem/LineItemType"] == "Tax")
    assert "reservation/EffectiveCost" not in tax and "resourceTags/user:Team" not in tax


def test_line_items_round_trip_through_files(spark, line_items, tmp_path):
    path = str(tmp_path / "items")
    feeds.write_line_items(line_items, path)
    back = feeds.read_line_items(spark, path)
    assert back.schema == line_items.schema
    assert back.exceptAll(line_items).isEmpty() and line_items.exceptAll(back).isEmpty()


def _stored(path):
    """Files of a landed feed with rows in them, and the bytes that they take."""
    files = [f for f in Path(path).rglob("part-*")]
    return len(files), sum(f.stat().st_size for f in files)


def test_landed_line_items_take_a_fraction_of_their_text(spark, line_items, tmp_path, monkeypatch):
    rows = line_items.crossJoin(spark.range(500).select("id")).withColumn("resource_id", F.sha2(F.col("id").cast("string"), 256))
    rows = rows.select(*line_items.columns).coalesce(1)
    text = feeds.to_vendor_json(rows).agg(F.sum(F.length("value"))).first()[0]
    monkeypatch.setattr(feeds, "FILE_ROWS", 2000, raising=False)
    feeds.write_line_items(rows, path := str(tmp_path / "items"))
    files, stored = _stored(path)
    assert files == 4 and stored < text / 5  # 6,500 rows
    back = feeds.read_line_items(spark, path)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_landed_billing_rows_take_a_fraction_of_their_text(spark, billing_rows, tmp_path, monkeypatch):
    rows = billing_rows.crossJoin(spark.range(500).select("id")).withColumn("billing_account_id", F.sha2(F.col("id").cast("string"), 256))
    rows = rows.select(*billing_rows.columns).coalesce(1)
    text = rows.agg(F.sum(F.length(feeds.vendor_json("*")))).first()[0]
    monkeypatch.setattr(feeds, "FILE_ROWS", 2000, raising=False)
    feeds.write_billing_rows(rows, path := str(tmp_path / "rows"))
    files, stored = _stored(path)
    assert files == 3 and stored < text / 5  # 4,500 rows
    back = feeds.read_billing_rows(spark, path)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_array_file(spark, line_items, tmp_path):
    texts = [json.loads(r.value) for r in feeds.to_vendor_json(line_items).collect()]
    path = tmp_path / "items.json"
    path.write_text(json.dumps(texts, indent=1))
    assert feeds.read_line_items(spark, str(path), array_file=True).exceptAll(line_items).isEmpty()


def test_empty_and_missing_credits_survive(spark, billing_rows, tmp_path):
    path = str(tmp_path / "rows")
    without = billing_rows.limit(1).withColumn("credits", F.lit(None).cast(billing_rows.schema["credits"].dataType))
    feeds.write_billing_rows(billing_rows.unionByName(without), path)
    text = spark.read.text(path)
    assert text.filter(F.col("value").contains('"credits":[]')).count() == 4
    assert text.filter(~F.col("value").contains('"credits"')).count() == 1
    back = feeds.read_billing_rows(spark, path)
    assert back.filter("credits IS NULL").count() == 1 and back.filter(F.size("credits") == 0).count() == 4


def test_malformed_feed_fails(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"identity/LineItemId": "a"}\n{broken\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        feeds.read_line_items(spark, str(path)).collect()


def test_rename_is_reversible(line_items):
    assert feeds.readable(feeds.wire_named(line_items)).columns == line_items.columns
    assert feeds.wire_named(line_items).columns == schemas.LINE_ITEM_WIRE.fieldNames()


@pytest.mark.parametrize(("feed", "size", "sizes"), [("aws", 6, [6, 6, 1]), ("gcp", 4, [4, 4, 1])])
def test_page_walk_returns_every_row_once(spark, line_items, billing_rows, feed, size, sizes):
    rows = line_items if feed == "aws" else billing_rows
    order = ["line_item_id"] if feed == "aws" else ["project.id", "sku.id", "usage_start_time"]
    order = [F.col(c) for c in order]
    token, seen, walked = None, [], []
    numbered = paging.number_feed(rows, order, chunks=3)
    while True:
        page = paging.page(numbered, token, size).collect()
        assert page == paging.early_page(rows, order, token, size).collect()
        walked.append(len(page))
        seen += page
        token = page[0].next_token
        if token is None:
            break
    assert walked == sizes
    whole = paging.assign_pages(rows, order, size)
    counts = paging.page_sizes(whole, size).orderBy("page").collect()
    assert [r.page_rows for r in counts] == sizes
    assert [r.next_token for r in counts] == [str(size), str(2 * size), None]
    key = ["line_item_id"] if feed == "aws" else ["sku", "project", "usage_start_time"]
    assert paging.page_walk_diff(whole, rows, key).isEmpty()
    assert len({str(r) for r in seen}) == rows.count()


def test_walk_diff_names_lost_and_repeated_rows(line_items):
    lost = line_items.filter("line_item_id <> 'use-4'")
    walked = lost.unionByName(line_items.filter("line_item_id = 'use-6'"))
    got = paging.page_walk_diff(walked, line_items, ["line_item_id"]).collect()
    assert {r.line_item_id: (r.walked, r.held) for r in got} == {"use-4": (0, 1), "use-6": (2, 1)}


def test_token_past_the_last_page_is_an_empty_page(line_items):
    feed = paging.number_feed(line_items, ["line_item_id"])
    assert feed.size == 13
    assert paging.page(feed, "13", 5).collect() == []
    assert paging.page(feed, "14", 5).first().line_item_id == "disk"


def test_a_page_reads_the_chunks_it_touches(spark):
    rows = spark.range(5000).withColumn("id", F.xxhash64("id"))
    feed = paging.number_feed(rows, ["id"], chunks=8)
    wanted = sorted(r.id for r in rows.collect())
    for offset in (0, 624, 3001, 4996):
        page = paging.page(feed, str(offset), 7)
        assert sorted(r.id for r in page.collect()) == wanted[offset : offset + 7]
        assert "PushedFilters: [Or(" in (plan := page._jdf.queryExecution().toString()) or "GreaterThanOrEqual(_position" in plan
    copies = paging.number_feed(spark.range(4000).select(F.lit(1).alias("id")), ["id"], chunks=4)
    assert max(n for _, _, n in copies.starts) < 2500 and copies.size == 4000


def test_landed_pages_explode_to_the_feed(spark, line_items, tmp_path):
    paged = feeds.wire_named(paging.assign_pages(line_items, ["line_item_id"], 6))
    pages = feeds.to_pages(paged, "page", "page_row", 6, "lineItems", "nextToken")
    path = str(tmp_path / "pages")
    pages.withColumn("billingPeriod", F.lit("2031-03")).write.json(path)
    landed = feeds.read_line_item_pages(spark, path)
    assert {r.nextToken: len(r.lineItems) for r in landed.collect()} == {"6": 6, "12": 6, None: 1}
    rows = feeds.readable(feeds.explode_pages(landed, "lineItems"))
    assert rows.select(*line_items.columns).exceptAll(line_items).isEmpty()
    assert rows.count() == 13
