import json

import pytest

from tests.helpers import actions, rows
from visitlens.operators import categories as cat
from visitlens.operators import documents as doc
from visitlens.operators import products as prod
from visitlens.plans.area_products import REPORT_KEYS, REPORT_SCHEMA, analyse_area_products, write_report
from visitlens.params import TaskParams
from visitlens.sinks.upsert import read_latest


def test_click_wins_over_order_over_pay_and_blanks_go(spark):
    exploded = cat.explode_category_actions(actions(
        spark,
        dict(session_id="a", order_category_ids="1||2| |3"),
        dict(session_id="b", click_category_id=" ", order_category_ids="7"),
        dict(session_id="c", click_category_id="5", order_category_ids="6", pay_category_ids="8"),
        dict(session_id="d", order_category_ids="\t", pay_category_ids="9| 9"),
        dict(session_id="e", click_category_id="1|2"),
        dict(session_id="f"),
        dict(session_id="g", order_category_ids="|", pay_category_ids="4"),
    ))
    assert rows(exploded) == sorted([
        ("a", "1", 1), ("a", "2", 1), ("a", "3", 1), ("b", "7", 1), ("c", "5", 0),
        ("d", "9", 2), ("d", " 9", 2), ("e", "1|2", 0)], key=str)


def exploded(spark, counts):
    data = [(f"s{i}", category, flag) for (category, flag), n in counts.items() for i in range(n)]
    return spark.createDataFrame(data, "session_id string, category_id string, flag int")


def test_top_categories_and_ties(spark):
    counts = {(c, 0): n for c, n in zip("abcd", (3, 2, 2, 1))} | {("d", 1): 5, ("a", 1): 1, ("b", 1): 4}
    assert rows(cat.top_categories(exploded(spark, counts), n=2)) == [
        ("a", 3, 0, 0), ("b", 2, 4, 0), ("d", 0, 5, 0)]
    assert rows(cat.top_categories(exploded(spark, counts), n=2, full_counts=True)) == [
        ("a", 3, 1, 0), ("b", 2, 4, 0), ("d", 1, 5, 0)]


def test_top_sessions_cover_every_flag_of_a_top_category(spark):
    data = [("s1", "a", 0)] * 3 + [("s2", "a", 0)] * 2 + [("s3", "a", 0)] * 2 + [("s4", "a", 1)]
    data += [("s5", "b", 1)] * 2
    df = spark.createDataFrame(data, "session_id string, category_id string, flag int")
    top = cat.top_category_sessions(df, cat.top_categories(df, n=1), n=2)
    assert rows(top) == [("a", 0, "s1", 3), ("a", 0, "s2", 2), ("a", 1, "s4", 1), ("b", 1, "s5", 2)]
    documents = {r["category_id"]: r for r in doc.category_sessions_json(top).collect()}
    assert json.loads(documents["a"]["click_sessions"]) == [
        {"sessionid": "s2", "count": 2}, {"sessionid": "s1", "count": 3}]
    assert documents["b"]["click_sessions"] == "" and documents["b"]["pay_sessions"] == ""


def cities(spark):
    return spark.createDataFrame(
        [(1, "X", "华东"), (101, "X", "华东"), (2, "Y", "西北"), (3, "Z", "华东")],
        "city_id int, city_name string, area string")


def products(spark):
    return spark.createDataFrame(
        [(7, "seven", '{"product_type":"0"}'), (8, "eight", '{"product_type":"1"}')],
        "product_id bigint, product_name string, extend_info string")


def clicks(spark, counts):
    data = [(city, product) for (city, product), n in counts.items() for _ in range(n)]
    return spark.createDataFrame(data, "city_id int, click_product_id string")


def test_cities_are_counted_apart(spark):
    counts = prod.area_product_count(
        clicks(spark, {(1, "7"): 2, (101, "7"): 3, (3, "7"): 1, (2, "7"): 1, (99, "7"): 4}), cities(spark))
    assert rows(counts, "area", "product_id", "click_count", "city_infos") == [
        ("华东", "7", 6, "1:X:2,3:Z:1,101:X:3"), ("西北", "7", 1, "2:Y:1")]


def test_a_city_listed_twice_counts_twice(spark):
    twice = cities(spark).where("city_id = 2").union(cities(spark).where("city_id = 2"))
    counts = prod.area_product_count(clicks(spark, {(2, "7"): 3}), twice)
    assert rows(counts, "click_count", "city_infos") == [(6, "2:Y:6")]


@pytest.mark.parametrize("fused", [False, True])
def test_report(spark, fused):
    counted = clicks(spark, {(1, "8"): 2, (1, "7"): 2, (2, "9"): 5, (2, "x"): 4, (2, "8"): 1})
    if fused:
        report = prod.area_top_products_of_clicks(counted, cities(spark), products(spark), n=2)
    else:
        report = prod.area_top_products(prod.area_product_count(counted, cities(spark)), products(spark), n=2)
    # Ranking comes first: in the second area both ranked products are unlisted.
    assert rows(report) == [
        ("华东", "A", "7", "1:X:2", 2, "seven", "自营商品"),
        ("华东", "A", "8", "1:X:2", 2, "eight", "第三方商品")]


def test_ties_go_to_the_smaller_number(spark):
    ranked = prod.rank_area_products(spark.createDataFrame(
        [("a", "10", 1), ("a", "9", 1), ("a", "100", 2), ("a", "x", 1)],
        "area string, product_id string, click_count bigint"), 2)
    assert rows(ranked, "product_id") == [("100",), ("9",)]


def test_job_reads_the_range_and_upserts(spark, tmp_path):
    records = actions(
        spark, dict(date="2024-01-01", click_product_id="7"), dict(date="2024-01-02", click_product_id="7"),
        dict(date="2024-01-02", click_product_id="null"), dict(date="2024-01-03", click_product_id="8"))
    path = str(tmp_path / "report")
    for end in ("2024-01-01", "2024-01-02"):
        params = TaskParams.from_document({"endDate": end})
        write_report(analyse_area_products(records, cities(spark), products(spark), params), path, 5)
    got = rows(read_latest(spark, path, REPORT_KEYS, REPORT_SCHEMA), "task_id", "product_id", "count")
    assert got == [(5, 7, 2)]
