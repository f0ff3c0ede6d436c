"""Landed pages followed by their tokens, and ids counted as bitmaps."""

import io
import json
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.operators import expectations, paging
from tallybook.sources import feeds, landed
from tallybook.streaming import sinks


@pytest.fixture
def feed(spark, line_items, tmp_path):
    """Thirteen line items as seven pages of two, and the folders of a stream over them."""
    paged = feeds.wire_named(paging.assign_pages(line_items, ["line_item_id"], 2))
    pages = feeds.to_pages(paged, "page", "page_row", 2, "lineItems", "nextToken")
    return pages.withColumn("billingPeriod", F.lit("2031-03")), str(tmp_path / "landed"), tmp_path


def land(feed, first, following):
    pages, path, _ = feed
    token = F.coalesce(F.col("nextToken").cast("int"), F.lit(13))
    landed.land(pages.filter((token > first) & (token <= following)), path, first, following)


def run(spark, feed):
    """What the stream has written after one more run, as ids."""
    _, path, folder = feed
    envelopes = feeds.parse_pages(landed.follow(spark, path), schemas.LINE_ITEM_PAGE)
    rows = feeds.readable(feeds.explode_pages(envelopes, "lineItems"))
    sinks.write_rows(rows, str(folder / "out"), str(folder / "checkpoint"))
    return sorted(r.line_item_id for r in sinks.written(spark, str(folder / "out"), rows.schema).collect())


def last_offset(folder):
    newest = max((folder / "checkpoint" / "offsets").glob("[0-9]*"), key=lambda p: int(p.name))
    return json.loads(newest.read_text().splitlines()[-1])


def test_the_checkpoint_alone_resumes_the_walk(spark, line_items, feed):
    wanted = sorted(r.line_item_id for r in line_items.collect())
    land(feed, 0, 4)
    land(feed, 8, 10)  # ahead of the pages before it
    assert run(spark, feed) == wanted[:4]
    assert last_offset(feed[2]) == {"token": "4"}
    assert run(spark, feed) == wanted[:4]
    land(feed, 4, 8)
    assert run(spark, feed) == wanted[:10]
    land(feed, 10, 13)
    assert run(spark, feed) == wanted
    assert last_offset(feed[2]) == {"token": "13"}
    whole = sinks.written(spark, str(feed[2] / "out")).select(*line_items.columns)
    assert whole.exceptAll(line_items).isEmpty() and line_items.exceptAll(whole).isEmpty()


def test_a_landing_shows_once_it_is_whole(spark, feed):
    assert run(spark, feed) == []
    land(feed, 0, 4)
    done = feed[2] / "landed" / "pages-0-4" / "_SUCCESS"
    done.unlink()
    assert run(spark, feed) == []
    done.touch()
    assert len(run(spark, feed)) == 4


def test_landings_that_are_no_walk_fail(spark, feed):
    land(feed, 0, 4)
    run(spark, feed)
    land(feed, 2, 6)  # not on the walk, but beside it
    with pytest.raises(StreamingQueryException, match="lies across others"):
        run(spark, feed)


def test_a_landing_that_went_missing_fails(tmp_path):
    for name in ("pages-0-4", "pages-4-6", "other"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "_SUCCESS").touch()
    (tmp_path / "pages-4-6" / "part-0.json").write_text("{}\n")
    walk = landed._Walk(f"file:{tmp_path}", 0)
    assert walk.latestOffset() == {"token": "6"}
    assert [p.path.rsplit("/", 2)[1] for p in walk.partitions({"token": "0"}, {"token": "6"})] == ["pages-4-6"]
    assert walk.partitions({"token": "6"}, {"token": "6"}) == []
    shutil.rmtree(tmp_path / "pages-4-6")
    with pytest.raises(landed.WalkError, match="from token 4 is gone"):
        walk.partitions({"token": "0"}, {"token": "6"})


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_lines_are_whole_whatever_the_block(monkeypatch, block):
    monkeypatch.setattr(landed, "BLOCK", block)
    text = "\n{\"a\": \"é\"}\n\n \nlonger than a block\nb\r\nlast"
    got = [line for lines in landed._lines(io.BytesIO(text.encode())) for line in lines]
    assert got == [line.encode() for line in text.split("\n") if line.strip()]


@pytest.mark.parametrize(
    "ids", [[], [None], [None, None], [1, 2, 3], [0, 0, -1, -1, -1, 7, None, None], [32768, 32769, 32768, 2**40, -(2**40)]]
)
def test_bitmaps_count_as_the_ids_do(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    wanted = expectations.unique(df, "check", ["id"]).collect()
    assert expectations.unique_number(df, "check", "id").collect() == wanted


def test_bitmaps_move_little(spark):
    df = spark.range(0, 400_000, 1, 8).select((F.col("id") % 399_999).alias("id"))
    tracker = spark.sparkContext._jsc.sc().statusStore()

    def moved(check):
        before = {s.stageId() for s in _stages(tracker)}
        assert check.first().violations == 1
        return sum(s.shuffleWriteBytes() for s in _stages(tracker) if s.stageId() not in before)

    bitmaps = moved(expectations.unique_number(df, "check", "id"))
    assert 0 < bitmaps < moved(expectations.unique(df, "check", ["id"])) / 4


def _stages(tracker):
    found = tracker.stageList(None, False, False, getattr(tracker, "stageList$default$4")(), None)
    return [found.apply(k) for k in range(found.size())]
