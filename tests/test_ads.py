"""Ad clicks on static data and as streams. Files of a stream are written in event order."""

import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from visitlens.operators import ads
from visitlens.sinks.files import console_writer
from visitlens.sources.clicks import file_lines, parse_ad_click
from visitlens.streaming import ad_realtime as rt

START = datetime(2024, 1, 1, 8, tzinfo=timezone.utc)
ALL = {"availableNow": True}


def click(seconds, user=500, ad=1, province="p", city="c"):
    millis = int((START + timedelta(seconds=seconds)).timestamp() * 1000)
    return f"{millis} {province} {city} {user} {ad}"


def static(spark, clicks):
    return parse_ad_click(spark.createDataFrame([(c,) for c in clicks], "value string"))


class Feed:
    """A folder of text files whose times follow the order of writing."""

    def __init__(self, path):
        self.path, self.count = path, 0
        path.mkdir()

    def write(self, clicks):
        self.count += 1
        hidden = self.path / f".{self.count}"
        hidden.write_text("\n".join(clicks) + "\n")
        stamp = time.time() - 1000 + 10 * self.count
        os.utime(hidden, (stamp, stamp))
        hidden.rename(self.path / f"{self.count}.txt")

    def clicks(self, spark):
        return parse_ad_click(file_lines(spark, str(self.path), max_files=1))


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "feed")


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive


def test_limit_is_exclusive_and_whitelisted_users_stay_off(spark):
    clicks = [click(i, user=100) for i in range(100)] + [click(i, user=101) for i in range(101)]
    clicks += [click(i, user=7) for i in range(500)]
    abusive = ads.user_click_windows(static(spark, clicks))
    whitelist = spark.range(100).select(F.col("id").alias("user_id"))
    entries = ads.blacklist_entries(ads.anti_join_whitelist(abusive, whitelist))
    assert rows(entries, "user_id", "count") == [(101, 101)]


def test_last_window_above_the_limit_counts(spark):
    clicks = [click(i) for i in range(5)] + [click(400 + i) for i in range(3)]
    entries = ads.blacklist_entries(ads.user_click_windows(static(spark, clicks), threshold=2))
    assert rows(entries, "user_id", "count") == [(500, 3)]


def test_top_ads_and_ties(spark):
    daily = spark.createDataFrame(
        [("d", "p", f"c{i % 2}", ad, n) for ad, n in ((9, 1), (3, 2), (5, 2), (4, 2), (1, 4)) for i in range(2)]
        + [("d", "q", "c", 1, 1)], "date string, province string, city string, ad_id int, click_count bigint")
    expected = [("d", "p", 1, 1, 8), ("d", "p", 2, 3, 4), ("d", "p", 3, 4, 4), ("d", "q", 1, 1, 1)]
    assert rows(ads.province_top_ads(daily, 3)) == expected
    assert rows(ads.province_top_ads(daily, 3, salts=4)) == expected


def test_sliding_counts_go_down_again(spark):
    counts = ads.ad_click_windows(static(spark, [click(0), click(30), click(560)]))
    got = dict(rows(counts, "date", "click_count"))
    assert got["20240101080100"] == 2 and got["20240101081000"] == 3 and got["20240101081100"] == 1
    assert len(got) == 19 and got["20240101081900"] == 1
    panes = ads.ad_click_windows(static(spark, [click(0), click(30), click(560)]), panes=True)
    assert rows(panes) == rows(counts)
    with pytest.raises(ValueError):
        ads.ad_click_windows(static(spark, []), "90 seconds", "30 seconds", panes=True)


IDLE = [click(0), click(1), click(5 * 30), click(17 * 30), click(30 * 30), click(31 * 30)]
# Batches 0, 5 and 17 belong together (eleven idle ones between), 30 starts again after twelve.
RUNS = [("08:00:00", "08:08:30", 4), ("08:15:00", "08:15:30", 2)]


def run_rows(df):
    return [(r["run_start"].strftime("%H:%M:%S"), r["run_end"].strftime("%H:%M:%S"), r["click_count"])
            for r in df.orderBy("run_start").collect()]


def test_idle_runs(spark):
    assert run_rows(ads.ad_idle_runs(static(spark, IDLE))) == RUNS


def test_idle_runs_as_a_stream(spark, feed, tmp_path):
    feed.write(IDLE[:3])
    feed.write(IDLE[3:])
    feed.write([click(3 * 3600, ad=2)])
    path = str(tmp_path / "runs")
    finish(rt.start_idle_runs(feed.clicks(spark), path, str(tmp_path / "cp"), trigger=ALL))
    assert run_rows(spark.read.parquet(path).where("ad_id = 1")) == RUNS


def test_windows_as_a_stream_equal_the_batch(spark, feed, tmp_path):
    files = [[click(60 * i + 7 * j, ad=j % 3) for j in range(6)] for i in range(8)]
    for clicks in files:
        feed.write(clicks)
    feed.write([click(4 * 3600, ad=9)])
    tables = rt.AdTables(str(tmp_path / "out"))
    finish(rt.start_windows(feed.clicks(spark), tables, str(tmp_path / "cp"), trigger=ALL))
    got = spark.read.parquet(tables.windows).where("ad_id < 9")
    expected = ads.ad_click_windows(static(spark, [c for clicks in files for c in clicks]))
    assert rows(got) == rows(expected)


def test_totals_survive_a_restart(spark, feed, tmp_path):
    tables = rt.AdTables(str(tmp_path / "out"))
    first = [click(i, ad=ad) for ad, n in ((1, 3), (2, 2), (3, 1)) for i in range(n)]
    second = [click(60 + i, ad=3) for i in range(5)] + [click(60, ad=4, province="q")]
    for clicks in (first, second):
        feed.write(clicks)
        finish(rt.start_totals(feed.clicks(spark), tables, str(tmp_path / "cp"), top=2, trigger=ALL))
    assert rows(rt.read_totals(spark, tables)) == rows(ads.ad_daily_counts(static(spark, first + second)))
    assert rows(rt.read_top_ads(spark, tables)) == [
        ("20240101", "p", 1, 3, 6), ("20240101", "p", 2, 1, 3), ("20240101", "q", 1, 4, 1)]


def test_compaction_of_totals(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rt, "COMPACT_EVERY", 2)
    tables, clicks = rt.AdTables(str(tmp_path)), []
    for batch_id in range(6):
        clicks += [click(batch_id, ad=batch_id % 3)]
        rt.update_totals(ads.ad_daily_counts(static(spark, clicks)), batch_id, tables)
    assert rows(rt.read_totals(spark, tables)) == rows(ads.ad_daily_counts(static(spark, clicks)))
    assert rows(rt.read_top_ads(spark, tables), "ad_id", "click_count") == [(0, 2), (1, 2), (2, 2)]


def test_a_repeated_batch_is_published_once(spark, tmp_path):
    tables = rt.AdTables(str(tmp_path))
    rt.publish_clean_clicks(static(spark, [click(0), click(1, user=600)]), 0, tables)
    before = sorted(p.name for p in (tmp_path / "clean_clicks" / "writer=batch" / "batch=0").iterdir())
    rt.publish_clean_clicks(static(spark, [click(0)]), 0, tables)
    assert sorted(p.name for p in (tmp_path / "clean_clicks" / "writer=batch" / "batch=0").iterdir()) == before
    assert spark.read.parquet(tables.clean).count() == 2


def test_a_late_window_does_not_replace_a_later_count(spark, tmp_path):
    tables = rt.AdTables(str(tmp_path))

    def windows(*found):
        return spark.createDataFrame([(rt_time(0), rt_time(end), user, n) for end, user, n in found],
                                     "window_start timestamp, window_end timestamp, user_id int, click_count bigint")

    rt.update_blacklist(windows((600, 1, 500), (600, 2, 200)), 0, tables, None)
    rt.update_blacklist(windows((300, 1, 101)), 1, tables, None)
    assert rows(rt.read_blacklist(spark, tables)) == [(1, 500), (2, 200)]
    # Taken off by hand; only windows after that time list the user again.
    rt.remove_users(spark.createDataFrame([(1,)], "user_id int"), tables, str(rt_time(900)))
    assert rows(rt.read_blacklist(spark, tables)) == [(2, 200)]
    rt.update_blacklist(windows((800, 1, 300)), 2, tables, None)
    assert rows(rt.read_blacklist(spark, tables)) == [(2, 200)]
    rt.update_blacklist(windows((1000, 1, 120)), 3, tables, None)
    assert rows(rt.read_blacklist(spark, tables)) == [(1, 120), (2, 200)]


def rt_time(seconds):
    from datetime import datetime, timedelta

    return datetime(2024, 1, 1) + timedelta(seconds=seconds)


def test_the_whitelist_is_read_for_every_batch(spark, tmp_path):
    tables, allowed = rt.AdTables(str(tmp_path)), []
    found = spark.createDataFrame([(rt_time(0), rt_time(600), 1, 500)],
                                  "window_start timestamp, window_end timestamp, user_id int, click_count bigint")

    def whitelist():
        return spark.createDataFrame([(u,) for u in allowed], "user_id int")

    allowed.append(1)
    rt.update_blacklist(found, 0, tables, whitelist)
    assert rows(rt.read_blacklist(spark, tables)) == []
    allowed.clear()
    rt.update_blacklist(found, 1, tables, whitelist)
    assert rows(rt.read_blacklist(spark, tables)) == [(1, 500)]


def test_another_checkpoint_is_refused(spark, feed, tmp_path):
    tables = rt.AdTables(str(tmp_path / "out"))
    feed.write([click(0)])
    finish(rt.start_totals(feed.clicks(spark), tables, str(tmp_path / "cp"), trigger=ALL))
    finish(rt.start_cleaner(feed.clicks(spark), tables, str(tmp_path / "cq"), trigger=ALL))
    feed.write([click(5)])
    for start, name in ((rt.start_totals, "cp2"), (rt.start_cleaner, "cq2")):
        query = start(feed.clicks(spark), tables, str(tmp_path / name), trigger=ALL)
        with pytest.raises(Exception, match="is written by"):
            query.awaitTermination(120)
    finish(rt.start_totals(feed.clicks(spark), tables, str(tmp_path / "cp"), trigger=ALL))
    finish(rt.start_cleaner(feed.clicks(spark), tables, str(tmp_path / "cq"), trigger=ALL))
    assert rows(rt.read_totals(spark, tables), "click_count") == [(2,)]
    assert spark.read.parquet(tables.clean).count() == 2
    rt.expire_clean_clicks(spark, tables, keep=1)
    assert spark.read.parquet(tables.clean).count() == 1


def test_totals_of_touched_dates_only_are_read(spark, tmp_path):
    tables = rt.AdTables(str(tmp_path))
    for day in range(4):
        rt.update_totals(ads.ad_daily_counts(static(spark, [click(86_400 * day)])), day, tables)
    plan = rt.totals_of_dates(spark, tables, ["20240102"])._jdf.queryExecution().executedPlan().toString()
    assert "20240102" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(rt.totals_of_dates(spark, tables, ["20240102"]), "date") == [("20240102",)]


def test_late_rows_are_counted(spark, feed, tmp_path):
    tables = rt.AdTables(str(tmp_path / "out"))
    for clicks in ([click(0)], [click(100_000)], [click(1), click(2)]):
        feed.write(clicks)
        query = rt.start_windows(feed.clicks(spark), tables, str(tmp_path / "cp"), trigger=ALL)
        finish(query)
    assert rt.dropped_rows(query) > 0


def test_whole_job(spark, feed, tmp_path):
    """Four running queries; a user is filtered from the batch after the one that listed them."""
    first = [click(i, user=700, ad=1) for i in range(4)] + [click(i, user=50, ad=2) for i in range(4)]
    second = [click(60, user=700, ad=1), click(61, user=800, ad=3)]
    last = [click(7200, user=900, ad=4)]
    whitelist = spark.range(100).select(F.col("id").cast("int").alias("user_id"))
    tables = rt.AdTables(str(tmp_path / "out"))
    queries = rt.start_ad_realtime(
        spark, feed.clicks(spark), tables.root, str(tmp_path / "cp"), whitelist, threshold=3,
        trigger={"processingTime": "1 second"})
    detector, cleaner, totals, windows = queries
    try:
        feed.write(first)
        cleaner.processAllAvailable()
        detector.processAllAvailable()
        assert rows(rt.read_blacklist(spark, tables)) == [(700, 4)]
        feed.write(second)
        cleaner.processAllAvailable()
        feed.write(last)
        cleaner.processAllAvailable()
        totals.processAllAvailable()
        windows.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    kept = static(spark, first + second[1:] + last)
    assert rows(rt.read_totals(spark, tables)) == rows(ads.ad_daily_counts(kept))
    closed = spark.read.parquet(tables.windows)
    assert rows(closed) == rows(ads.ad_click_windows(static(spark, first + second[1:])))


def test_console_writer_is_configured(spark, feed):
    assert console_writer(feed.clicks(spark)) is not None
