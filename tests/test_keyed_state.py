"""Keyed state on streams: totals that expire, top ads that are kept up, versions that go."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from checks.compare import differences
from tests.helpers import rows
from tests.test_ads import ALL, IDLE, Feed, click, finish, static
from visitlens.operators import ads
from visitlens.sinks import upsert as up
from visitlens.streaming import ad_realtime as rt
from visitlens.streaming.keyed_state import DEFAULT_STORE, IDLE_SCHEMA, STORE, IdleTotals, ProvinceTop, SliceCounts

SF_DIR = "/root/testdata/sf0.001"
ONE = {"trigger": ALL, "state_partitions": 1}


def totals(spark, path):
    found = spark.read.schema(IDLE_SCHEMA).parquet(path).where("ad_id = 1")
    return rows(found.withColumn("batch", F.date_format("batch", "HH:mm:ss")), "batch", "click_count", "ended")


# Clicks in batches 0, 5, 17, 30 and 31; the twelfth idle batch after 17 is 29.
EXPECTED = [("08:00:00", 2, False), ("08:02:30", 3, False), ("08:08:30", 4, False), ("08:14:30", 4, True),
            ("08:15:00", 1, False), ("08:15:30", 2, False), ("08:21:30", 2, True)]


def test_idle_totals_over_restarts(spark, tmp_path):
    """The same rows whether the clicks come at once or over restarts on the checkpoint; timers end the last total."""
    marks = [click(3 * 3600, ad=2)]
    for name, files in (("once", [IDLE + marks]), ("parts", [IDLE[:4], IDLE[4:] + marks])):
        feed = Feed(tmp_path / f"feed-{name}")
        for part in files:
            feed.write(part)
            finish(rt.start_idle_totals(feed.clicks(spark), str(tmp_path / name), str(tmp_path / f"cp-{name}"), **ONE))
        assert totals(spark, str(tmp_path / name)) == EXPECTED


def test_expired_state_is_gone(spark, tmp_path):
    """After a total has ended by its timer, a later batch starts at 0, and late clicks are dropped."""
    feed = Feed(tmp_path / "feed")
    for part in ([click(0), click(1)], [click(2 * 3600, ad=2)], [click(3600), click(2 * 3600), click(5 * 3600, ad=2)]):
        feed.write(part)
        query = rt.start_idle_totals(feed.clicks(spark), str(tmp_path / "out"), str(tmp_path / "cp"), **ONE)
        finish(query)
    assert totals(spark, str(tmp_path / "out")) == [
        ("08:00:00", 2, False), ("08:06:00", 2, True), ("10:00:00", 1, False), ("10:06:00", 1, True)]


def test_top_ads_from_state(spark, tmp_path):
    """Ranks after each restart equal the ranking of all clicks so far; unchanged ranks are not written again."""
    feed, tables, seen = Feed(tmp_path / "feed"), rt.AdTables(str(tmp_path / "out")), []
    parts = [
        [click(i, ad=ad) for ad, n in ((1, 3), (2, 2), (3, 1)) for i in range(n)],
        [click(60 + i, ad=3) for i in range(5)] + [click(60, ad=4, province="q")],
        [click(90, ad=20), click(91, ad=20), click(92, ad=2), click(93, ad=36), click(94, ad=36), click(95, ad=36)],
    ]
    for part in parts:
        seen += part
        feed.write(part)
        finish(rt.start_top_ads(feed.clicks(spark), tables, str(tmp_path / "cp"), top=3, **ONE))
        daily = ads.ad_daily_counts(static(spark, seen))
        assert rows(rt.read_top_ads(spark, tables)) == rows(ads.province_top_ads(daily, 3))
    last = spark.read.parquet(f"{tables.top_ads}/version={up.next_version(spark, tables.top_ads) - 1}")
    assert rows(last, "province", "rank", "ad_id") == [("p", 2, 2), ("p", 3, 36)] or \
        ("q", 1, 4) not in rows(last, "province", "rank", "ad_id")


def test_a_batch_of_ranks_reads_no_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rt, "read_latest", None)
    feed, tables = Feed(tmp_path / "feed"), rt.AdTables(str(tmp_path / "out"))
    feed.write([click(0), click(1, ad=2)])
    finish(rt.start_top_ads(feed.clicks(spark), tables, str(tmp_path / "cp"), **ONE))
    assert spark.read.parquet(tables.top_ads).count() == 2


def test_old_versions_go(spark, tmp_path, monkeypatch):
    """However many batches, two folds' worth of versions and one for each date that no longer changes are listed."""
    monkeypatch.setattr(rt, "COMPACT_EVERY", 3)
    tables, clicks, most = rt.AdTables(str(tmp_path)), [], 0
    for batch in range(26):
        clicks.append(click(16_000 * batch, ad=batch % 4))
        day = [c for c in clicks if (int(c.split()[0]) // 86_400_000) == int(clicks[-1].split()[0]) // 86_400_000]
        rt.update_totals(ads.ad_daily_counts(static(spark, day)), batch, tables, top=None)
        most = max(most, len(up._versions(spark, tables.totals)))
    dates = {int(c.split()[0]) // 86_400_000 for c in clicks}
    assert most <= 2 * rt.COMPACT_EVERY + len(dates)
    assert len(list((tmp_path / "ad_real_time_state").glob("version=*"))) == len(up._versions(spark, tables.totals))
    assert rows(rt.read_totals(spark, tables)) == rows(ads.ad_daily_counts(static(spark, clicks)))


def test_only_versions_of_a_date_are_read(spark, tmp_path):
    tables = rt.AdTables(str(tmp_path))
    for day in range(4):
        rt.update_totals(ads.ad_daily_counts(static(spark, [click(86_400 * day)])), day, tables, top=None)
    found = rt.totals_of_dates(spark, tables, ["20240102"])
    assert len(found.inputFiles()) == 1 and "version=1/" in found.inputFiles()[0]
    assert rt.totals_of_dates(spark, tables, ["20230101"]).collect() == []


def test_chained_windows_update_less_state(spark, tmp_path):
    """A click updates one state of the first operator; late clicks are dropped and counted there."""
    feed, tables = Feed(tmp_path / "feed"), rt.AdTables(str(tmp_path / "out"))
    clicks = [click(i % 50, ad=1) for i in range(200)] + [click(60 * i, ad=2) for i in range(30)]
    feed.write(clicks)
    query = rt.start_windows(feed.clicks(spark), tables, str(tmp_path / "cp"), **ONE)
    finish(query)
    operators = [p.stateOperators for p in query.recentProgress if p.numInputRows][0]
    assert len(operators) == 2 and max(o.numRowsUpdated for o in operators) <= 31
    feed.write([click(3 * 3600, ad=9)])
    feed.write([click(1), click(2)])
    for _ in range(2):
        query = rt.start_windows(feed.clicks(spark), tables, str(tmp_path / "cp"), **ONE)
        finish(query)
    got = spark.read.parquet(tables.windows).where("ad_id < 9")
    assert rows(got) == rows(ads.ad_click_windows(static(spark, clicks)))


def test_user_windows_in_panes(spark):
    clicks = static(spark, [click(37 * i, user=i % 3) for i in range(60)])
    assert rows(ads.user_click_windows(clicks, threshold=2, panes=True)) == rows(ads.user_click_windows(clicks, threshold=2))


@pytest.fixture
def plain(spark):
    """The session with Spark's default state store, as one that the library did not build."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, DEFAULT_STORE)
    yield spark
    assert spark.conf.get(STORE) == DEFAULT_STORE
    spark.conf.set(STORE, before)


def test_idle_totals_in_a_plain_session(plain, tmp_path):
    feed = Feed(tmp_path / "feed")
    for part in (IDLE[:4], [*IDLE[4:], click(3 * 3600, ad=2)]):
        feed.write(part)
        finish(rt.start_idle_totals(feed.clicks(plain), str(tmp_path / "out"), str(tmp_path / "cp"), **ONE))
    assert totals(plain, str(tmp_path / "out")) == EXPECTED


def test_top_ads_in_a_plain_session(plain, tmp_path):
    feed, tables, clicks = Feed(tmp_path / "feed"), rt.AdTables(str(tmp_path / "out")), [click(i, ad=i % 3) for i in range(8)]
    for part in (clicks[:5], clicks[5:]):
        feed.write(part)
        finish(rt.start_top_ads(feed.clicks(plain), tables, str(tmp_path / "cp"), **ONE))
    assert rows(rt.read_top_ads(plain, tables)) == rows(ads.province_top_ads(ads.ad_daily_counts(static(plain, clicks)), 5))


def test_all_state_of_the_job_leaves_the_heap_in_a_plain_session(plain, tmp_path):
    """Windows per user are several rows a click, too many for the heap that Spark's default store keeps them in."""
    feed, tables = Feed(tmp_path / "feed"), rt.AdTables(str(tmp_path / "out"))
    feed.write([click(i) for i in range(8)])
    starts = {"detector": lambda at: rt.start_detector(feed.clicks(plain), tables, at, **ONE),
              "totals": lambda at: rt.start_totals(feed.clicks(plain), tables, at, top=None, **ONE),
              "windows": lambda at: rt.start_windows(feed.clicks(plain), tables, at, **ONE)}
    for name, start in starts.items():
        query = start(str(tmp_path / name))
        finish(query)
        states = [s for p in query.recentProgress for s in p.stateOperators]
        assert states and all("rocksdbPutCount" in s.customMetrics for s in states), name


LOAD = """
import importlib.util, pickle, sys
assert importlib.util.find_spec("visitlens") is None
print(*(type(p).__name__ for p in pickle.load(sys.stdin.buffer)))
"""


def test_processors_load_where_the_library_is_missing(tmp_path):
    """The worker that Spark starts beside the driver gets none of the session's Python files."""
    sent = cloudpickle.dumps([IdleTotals(30, 12), SliceCounts(5), ProvinceTop(5)])
    plain_path = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    loaded = subprocess.run([sys.executable, "-c", LOAD], input=sent, cwd=tmp_path, env=plain_path, capture_output=True)
    assert loaded.stdout.split() == [b"IdleTotals", b"SliceCounts", b"ProvinceTop"], loaded.stderr.decode()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
@pytest.mark.parametrize("name", ["job_ad_realtime", "stream_result_tables"])
def test_query_in_a_plain_session(plain, name):
    assert differences(plain, SF_DIR, name) is None
