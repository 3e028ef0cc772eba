"""Stored tables and their plans, parametrised SQL, table functions, variants, observed counts, state as a table."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.helpers import actions, lines, rows
from tests.test_ads import ALL, Feed, click, finish, static
from tests.test_sources_sinks import GOOD
from visitlens.functions import variants
from visitlens.functions.business import product_type
from visitlens.functions.sql_names import create_area_product_function
from visitlens.operators import ads
from visitlens.operators import filters as flt
from visitlens.operators import products as prod
from visitlens.params import TaskParams
from visitlens.sinks.action_table import join_by_session, write_action_table, write_session_table
from visitlens.sources import observed
from visitlens.sources import tables as src
from visitlens.streaming import ad_realtime as rt

DAYS = [f"2024-01-{day:02d}" for day in range(1, 9)]


def many(spark):
    return actions(spark, *[dict(date=DAYS[i % 8], session_id=f"s{i % 13}", page_id=i, city_id=i % 3) for i in range(240)])


def scans(df):
    """Numbers of files read, one per scan of a table, after running without adaptive plans."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    found = []
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        if metric.isDefined():
            found.append(metric.get().value())
    return found


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def table(spark, request):
    name = f"actions_{request.node.name.split('[')[0]}"
    write_action_table(many(spark), name, buckets=4)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_date_filter_skips_files(spark, table, plain_plans):
    whole, part = spark.table(table), src.scan_catalog_table(spark, table, None, F.col("date") == DAYS[2])
    assert part.count() == 30 and whole.count() == 240
    part.collect(), whole.collect()
    assert 0 < scans(part)[0] < scans(whole)[0] / 4
    assert "PartitionFilters: [isnotnull(date" in part._jdf.queryExecution().executedPlan().toString()
    assert rows(whole.select("date", "session_id", "page_id")) == rows(many(spark).select("date", "session_id", "page_id"))


def test_chosen_dates_skip_files(spark, table, plain_plans, tmp_path):
    spark.createDataFrame([(d, i) for i, d in enumerate(DAYS)], "date string, n int").write.parquet(str(tmp_path / "days"))
    chosen = spark.read.parquet(str(tmp_path / "days")).where("n IN (1, 4)")
    found = src.scan_chosen_dates(spark, table, chosen, ["date", "page_id"])
    got = found.collect()
    assert {r.date for r in got} == {DAYS[1], DAYS[4]} and len(got) == 60
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    files = len(spark.table(table).inputFiles())
    assert max(scans(found)) <= files / 3


def test_tables_with_the_same_buckets_meet_without_a_shuffle(spark, table, plain_plans):
    sample = spark.createDataFrame([(f"s{i}", DAYS[i]) for i in range(5)], "session_id string, date string")
    write_session_table(sample, "sample_sessions", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_by_session(spark.table(table), spark.table("sample_sessions"), "date")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        counted = spark.table(table).groupBy("session_id").count()
        assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
        expected = many(spark).join(sample, ["session_id", "date"])
        assert rows(joined.select("session_id", "date", "page_id")) == rows(expected.select("session_id", "date", "page_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE sample_sessions")


@pytest.mark.parametrize("params", [
    TaskParams(), TaskParams(start_date=DAYS[2]), TaskParams(end_date=DAYS[2], sex="ma'le"),
    TaskParams(professionals=("a,b", "'; DROP TABLE users; --"), keywords=("", "x")),
    TaskParams(start_age=20, end_age=30, cities=("c\"1",)), TaskParams(sex="nobody")])
def test_parametrised_filters(spark, params):
    many(spark).createOrReplaceTempView("sql_actions")
    users = spark.createDataFrame(
        [(1, "u", "n", 25, "a,b", "c\"1", "ma'le"), (2, "u", "n", 50, "'; DROP TABLE users; --", "c", "female")],
        "user_id bigint, user_name string, name string, age int, professional string, city string, sex string")
    users.createOrReplaceTempView("sql_users")
    found = src.filter_actions_sql(spark, "sql_actions", "sql_users", params)
    assert rows(found) == rows(flt.filter_actions_by_task(many(spark), users, params))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) == params.needs_users


def test_area_product_function_in_another_session(spark, table):
    clicks = actions(spark, *[dict(date=DAYS[i % 4], click_product_id=["7", " ", "null", "8"][i % 4], city_id=i % 3)
                              for i in range(40)])
    write_action_table(clicks, table, buckets=2)
    cities = spark.createDataFrame([(0, "A", "x"), (1, "B", "x"), (2, "C", "y")], "city_id int, city_name string, area string")
    cities.write.mode("overwrite").saveAsTable("function_cities")
    create_area_product_function(spark, table, "function_cities", "area_products_test")
    other = spark.newSession()
    for start, end in ((DAYS[0], DAYS[3]), (None, DAYS[2]), (DAYS[3], None), (None, None), ("2030-01-01", None)):
        expected = prod.area_product_count(prod.product_clicks(clicks, start, end), cities)
        got = other.sql("SELECT * FROM area_products_test(:a, :b)", args={"a": start, "b": end})
        names = ["area", "product_id", "click_count", "city_infos"]
        assert rows(got, *names) == rows(expected, *names)
    spark.sql("DROP FUNCTION area_products_test")
    spark.sql("DROP TABLE function_cities")


def test_variants(spark, tmp_path):
    texts = ['{"product_type":"0","n":[1,"two",{"x":3}]}', '{"product_type":0}', '{"product_type":"1"', None, "", "[]", "7",
             '{"n":{"x":"y"}}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, info string")
    variants.with_variant(df, "info", "v").write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    v = F.col("v")
    got = stored.select("id", variants.field(v, "$.n[0]", "int"), variants.field(v, "$.n[1]"), variants.field(v, "$.n[1]", "int"),
                        variants.field(v, "$.n[2].x", "int"), v.isNull())
    assert rows(got) == sorted([
        (0, 1, "two", None, 3, False), (1, None, None, None, None, False), (2, None, None, None, None, True),
        (3, None, None, None, None, True), (4, None, None, None, None, True), (5, None, None, None, None, False),
        (6, None, None, None, None, False), (7, None, None, None, None, False)], key=str)
    labels = stored.select("id", variants.product_type_of(v).alias("a"), product_type(F.col("info")).alias("b")).collect()
    assert all(r.a == r.b for r in labels if r.id != 2)
    record = df.select(variants.record_variant("id", "info").alias("r")).select(variants.field(F.col("r"), "$.id", "int"))
    assert rows(record) == [(i,) for i in range(8)]


def test_observed_lines_of_a_batch(spark):
    observation = Observation()
    good = observed.observed_actions(lines(spark, GOOD, GOOD, "x", GOOD.replace(",1,s", ",one,s"), ""), observation)
    assert good.count() == 2 and "reason" not in good.columns
    assert {k: v for k, v in observation.get.items() if v} == {"accepted": 2, "width": 2, "number:user_id": 1}


def test_observed_counts_and_late_rows_of_a_stream(spark, tmp_path):
    """Counts come from the batches that make the result, over restarts; late rows stand beside them."""
    feed, totals = Feed(tmp_path / "feed"), observed.StreamTotals()
    spark.streams.addListener(totals)
    try:
        for part in ([click(0), "x", "1 p c u 1"], [click(100_000)], [click(1), click(2, ad=2)]):
            feed.write(part)
            clicks = observed.observed_clicks(spark.readStream.text(str(feed.path)), "clicks_test")
            query = rt.start_windows(clicks, rt.AdTables(str(tmp_path / "out")), str(tmp_path / "cp"), trigger=ALL,
                                     state_partitions=1)
            finish(query)
            totals.wait_for(query)
    finally:
        spark.streams.removeListener(totals)
    assert totals.counts("clicks_test") == {"accepted": 4, "width": 1, "number:user_id": 1, "late": 2}
    assert totals.counts("other") == {}


def test_lost_totals_are_rebuilt_from_the_state(spark, tmp_path):
    import shutil

    feed, tables, cp = Feed(tmp_path / "feed"), rt.AdTables(str(tmp_path / "out")), str(tmp_path / "cp")
    how = {"watermark": "10 days", "trigger": ALL, "state_partitions": 2, "top": None}
    first, second = [click(i, ad=i % 3) for i in range(9)], [click(86_400 + i, ad=i % 2) for i in range(4)]
    feed.write(first)
    finish(rt.start_totals(feed.clicks(spark), tables, cp, **how))
    assert rows(rt.state_totals(spark, cp)) == rows(rt.read_totals(spark, tables))
    shutil.rmtree(tables.totals)
    rt.rebuild_totals(spark, tables, cp)
    assert rows(rt.read_totals(spark, tables)) == rows(ads.ad_daily_counts(static(spark, first)))
    feed.write(second)
    finish(rt.start_totals(feed.clicks(spark), tables, cp, **how))
    assert rows(rt.read_totals(spark, tables)) == rows(ads.ad_daily_counts(static(spark, first + second)))
    assert rows(rt.state_totals(spark, cp)) == rows(rt.read_totals(spark, tables))


CONSOLE = """
import sys
sys.path.insert(0, {root!r})
from visitlens.session import build_session
from visitlens.sinks.files import console_writer
from visitlens.sources.clicks import file_lines
spark = build_session("console", "local[1]", {{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "1"}})
query = console_writer(file_lines(spark, {path!r})).option("checkpointLocation", {cp!r}).trigger(availableNow=True).start()
query.awaitTermination()
"""


def test_the_console_shows_five_rows(tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.txt").write_text("\n".join(f"line-{i}" for i in range(9)) + "\n")
    code = CONSOLE.format(root=str(Path(__file__).parent.parent), path=str(tmp_path / "lines"), cp=str(tmp_path / "cp"))
    shown = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240).stdout
    assert "Batch: 0" in shown and shown.count("line-") == 5 and "only showing top 5 rows" in shown
