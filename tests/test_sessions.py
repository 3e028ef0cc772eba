import json
import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import actions, rows
from visitlens.operators import documents as doc
from visitlens.operators import sampling as smp
from visitlens.operators import sessions as ses
from visitlens.operators.ranking import top_n
from visitlens.params import TaskParams
from visitlens.plans.session_analysis import analyse_sessions, write_analysis

START = datetime(2024, 1, 1, 8)


def at(seconds):
    return (START + timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def session_of(name, *seconds):
    return [dict(session_id=name, action_time=at(s)) for s in seconds]


LENGTHS = [0, 1, 5, 6, 10, 11, 30, 31, 60, 61, 180, 181, 360, 361]


def lengths(spark):
    records = [r for length in LENGTHS for r in session_of(f"s{length:03}", length, 0, length // 2)]
    return ses.session_length(actions(spark, *records))


def test_length_and_levels(spark):
    sessions = lengths(spark)
    assert rows(sessions) == [(f"s{n:03}", 3, float(n)) for n in LENGTHS]
    levels = dict(rows(ses.session_length_levels(sessions)))
    assert levels == {"A": 1, "B": 2, "C": 2, "D": 2, "E": 2, "F": 2, "G": 2, "H": 1}
    assert sum(levels.values()) == len(LENGTHS)


def test_totals(spark):
    assert rows(ses.session_totals(lengths(spark))) == [(len(LENGTHS), float(sum(LENGTHS)), 1)]


def test_totals_of_nothing(spark):
    none = ses.session_length(actions(spark, *session_of("s", 0)).where("false"))
    assert rows(ses.session_totals(none)) == [(0, 0.0, 0)]
    assert rows(ses.session_length_levels(none)) == []


def test_length_bands_are_half_open(spark):
    shares = {r["band"]: r["session_count"] for r in ses.session_visit_length_ratios(lengths(spark)).collect()}
    assert shares == {"1s_4s": 1, "4s_7s": 2, "10s_30s": 2, "30s_60s": 2, "1m_3m": 2, "3m_10m": 4}


def test_shares_are_of_all_sessions(spark):
    shares = ses.session_visit_length_ratios(lengths(spark))
    assert shares.agg(F.sum("ratio")).first()[0] == pytest.approx(13 / 14)
    steps = rows(ses.session_step_length_ratios(lengths(spark)))
    assert steps == [("1_3", 14, 1.0)]


def test_session_over_two_hours_counts_in_both(spark):
    records = actions(spark, *session_of("s", 58 * 60, 63 * 60))
    assert rows(ses.session_length(records)) == [("s", 2, 300.0)]
    hourly = ses.session_hour_lengths(records)
    assert rows(hourly) == [("s", "2024-01-01", 8, 0), ("s", "2024-01-01", 9, 0)]
    assert rows(ses.hour_session_count(hourly)) == [("2024-01-01", 8, 1), ("2024-01-01", 9, 1)]
    assert rows(ses.hour_invalid_count(hourly)) == [("2024-01-01", 8, 1), ("2024-01-01", 9, 1)]


def test_hour_length_is_whole_seconds_and_valid_hours_have_no_invalid_row(spark):
    hourly = spark.createDataFrame(
        [("a", "d", 1, 1500), ("b", "d", 1, 1400), ("c", "d", 2, 999)],
        "session_id string, day string, hour int, length_ms bigint")
    assert rows(ses.hour_session_length(hourly)) == [("d", 1, 2), ("d", 2, 0)]
    assert rows(ses.hour_invalid_count(hourly)) == [("d", 2, 1)]


def test_bad_times_are_left_out(spark):
    records = actions(spark, *session_of("s", 0, 10), dict(session_id="s", action_time="yesterday"))
    assert rows(ses.session_length(records)) == [("s", 2, 10.0)]


def test_metrics_document(spark):
    hours = ses.session_hours(actions(
        spark, *session_of("a", 0, 7), *session_of("b", 5), *session_of("c", 3599, 3601)).withColumn(
        "ts", F.to_timestamp("action_time")))
    document = doc.session_aggr_json(ses.hours_to_sessions(hours), ses.hours_to_hourly(hours)).first()[0]
    day = "2024-01-01"
    assert json.loads(document) == {
        "total_session_count": 3, "total_session_length": "9", "invalid_session_count": 1,
        "pre_session_type_of_count": [
            {"type": "A", "count": 1}, {"type": "B", "count": 1}, {"type": "C", "count": 1}],
        "pre_hour_of_session_count": [
            {"day": day, "hour": 8, "count": 3}, {"day": day, "hour": 9, "count": 1}],
        "pre_hour_of_session_length": [
            {"day": day, "hour": 8, "length": 7}, {"day": day, "hour": 9, "length": 0}],
        "pre_hour_of_invalid_session_count": [
            {"day": day, "hour": 8, "invalid": 2}, {"day": day, "hour": 9, "invalid": 1}],
    }


def test_metrics_document_of_nothing(spark):
    hours = ses.session_hours(actions(spark, *session_of("s", 0)).where("false"))
    document = doc.session_aggr_json(ses.hours_to_sessions(hours), ses.hours_to_hourly(hours)).first()[0]
    got = json.loads(document)
    assert got["total_session_count"] == 0 and got["total_session_length"] == "0"
    assert got["pre_hour_of_session_count"] == []


def hourly(spark, **sizes):
    data = [(f"{day}-{i}", day, 8, i) for day, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "session_id string, day string, hour int, n_actions int")


def per_day(df):
    return {r["day"]: r["count"] for r in df.groupBy("day").count().collect()}


def test_sample_meets_the_floor_and_is_a_subset(spark):
    population = hourly(spark, tiny=2, small=5, middle=1000, large=20000)
    sample = smp.sample_sessions(population, 0.01)
    got = per_day(sample)
    assert got["tiny"] == 2 and got["small"] == 3 and got["middle"] >= 10 and got["large"] >= 50
    assert 150 < got["large"] < 260  # the share may exceed the cap, which holds for the top-up
    assert sample.count() == sample.distinct().count()
    assert sample.join(population, smp.KEYS, "left_anti").count() == 0


def test_sample_is_the_same_again(spark):
    population = hourly(spark, d=3000)
    first, second = (rows(smp.sample_sessions(population.repartition(n), 0.02)) for n in (1, 7))
    assert first == second
    assert first != rows(smp.sample_sessions(population, 0.02, seed=7))


def test_need(spark):
    need = {r["day"]: r["need"] for r in smp.sample_need(
        hourly(spark, a=1, b=399, c=400, d=4999, e=5100), 0.01).collect()}
    assert need == {"a": 3, "b": 3, "c": 4, "d": 49, "e": 50}


def test_poisson_repeats_rows_and_keeps_its_share(spark):
    population = hourly(spark, d=20000)
    drawn = smp.sample_stratified(population, 0.1, "poisson")
    total, different = drawn.count(), drawn.distinct().count()
    assert 1850 < total < 2150 and different < total
    assert 1780 < different < 2030  # 20000 * (1 - exp(-0.1)) = 1903
    bounded = smp.sample_count_bounded(drawn).first()
    assert bounded["n_sampled"] == total and bounded["session_ids"] is None


def test_count_bounded_names_small_samples(spark):
    got = smp.sample_count_bounded(hourly(spark, a=2, b=50, c=49)).collect()
    ids = {r["day"]: (r["n_sampled"], r["session_ids"] and len(r["session_ids"])) for r in got}
    assert ids == {"a": (2, 2), "b": (50, None), "c": (49, 49)}


def test_items_without_the_excluded_ones(spark):
    items = hourly(spark, a=10, b=2)
    excluded = items.where("session_id IN ('a-1', 'a-2')")
    chosen = smp.sample_items(items, ["day"], "session_id", 5, exclude=excluded)
    assert per_day(chosen) == {"a": 5, "b": 2}
    assert not {"a-1", "a-2"} & {r["session_id"] for r in chosen.collect()}
    by_column = items.withColumn("need", F.when(F.col("day") == "a", 3).otherwise(0))
    assert per_day(smp.sample_items(by_column, ["day"], "session_id", F.col("need"))) == {"a": 3}


def test_detail_is_the_sampled_hour_only(spark):
    records = actions(spark, *session_of("s", 0, 10, 3700), *session_of("t", 20))
    sample = spark.createDataFrame([("s", "2024-01-01", 8)], "session_id string, day string, hour int")
    detail = smp.session_sample_detail(records, sample)
    assert rows(detail, "session_id", "action_time") == [("s", at(0)), ("s", at(10))]


def test_sampled_actions_equal_the_joined_sample(spark):
    records = actions(spark, *[
        dict(session_id=f"s{i}", action_time=at(60 * (i % 180) + j)) for i in range(900) for j in range(3)])
    population = ses.session_hour_lengths(records)
    for mode in ("bernoulli", "poisson"):
        sample = smp.sample_sessions(population, 0.05, mode)
        joined = smp.session_sample_detail(records, sample)
        fused = smp.sampled_actions(records, population, 0.05, mode)
        assert rows(fused, "session_id", "action_time") == rows(joined, "session_id", "action_time")


def test_top_sessions_of_an_hour_with_ties(spark):
    detail = smp.with_hour(actions(spark, *[
        r for name, n in (("a", 1), ("b", 2), ("c", 2), ("d", 2), ("e", 3), ("f", 2), ("g", 1))
        for r in session_of(name, *range(n))]))
    assert [r[0] for r in rows(smp.hour_top_sessions(detail), "session_id")] == ["b", "c", "d", "e", "f"]


@pytest.mark.parametrize("n", [1, 1_000, 1_001])
def test_sessions_of_any_size_are_stored_record_by_record(spark, n):
    detail = smp.with_hour(actions(spark, *session_of("s", *[i % 3_600 for i in range(n)])))
    stored = doc.sample_session_rows(detail, smp.hour_top_sessions(detail), 9).collect()
    assert sorted(json.loads(r["record"])["action_time"] for r in stored) == sorted(at(i % 3_600) for i in range(n))
    assert {(r["task_id"], r["session_id"]) for r in stored} == {(9, "s")}


def test_items_by_a_column_have_no_hidden_limit(spark):
    items = spark.range(3_000).selectExpr("id % 2 AS g", "id AS item", "CASE id % 2 WHEN 0 THEN 1200 ELSE 60 END AS n")
    chosen = smp.sample_items(items, ["g"], "item", F.col("n"))
    assert {r["g"]: r["count"] for r in chosen.groupBy("g").count().collect()} == {0: 1_200, 1: 60}
    few = smp.sample_items(items, ["g"], "item", 60)
    assert set(map(tuple, few.where("g = 1").select("item").collect())) == set(
        map(tuple, chosen.where("g = 1").select("item").collect()))


def test_a_share_of_one_draws_every_key(spark):
    assert smp.key_limit(1.0) > "f" * 32
    population = ses.session_hour_lengths(actions(spark, *[r for i in range(40) for r in session_of(f"s{i}", i)]))
    assert smp.sample_stratified(population, 1.0).count() == population.count()


def test_copies_follow_the_poisson_distribution():
    for ratio in (0.01, 0.1, 3.0):
        limits = smp._copy_limits(ratio, "poisson")
        term, rest = math.exp(-ratio), 1.0
        for n, limit in enumerate(limits):
            rest -= term
            assert abs(int(limit, 16) - rest * 2**32) <= 1
            term *= ratio / (n + 1)
        assert rest - term < 2**-31
    for ratio in (0, -1, 30):
        with pytest.raises(ValueError):
            smp._copy_limits(ratio, "poisson")


def test_no_side_is_broadcast_by_claim(spark):
    """The date column does not bound the hours, so nothing that depends on them is forced."""
    rows_ = [r for i in range(60) for r in session_of(f"s{i}", 3_600 * i)]
    records = actions(spark, *[{**r, "date": "2024-01-01"} for r in rows_])
    params = TaskParams.from_document({"startDate": "2024-01-01", "endDate": "2024-01-01"})
    result = analyse_sessions(records, None, params, 1, keep=False)
    for name in ("sampled_records", "sampled_rows", "category_sessions", "category_records"):
        plan = getattr(result, name)._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in plan and "UnresolvedHint" not in plan, name


def test_ranks_beyond_a_thousand_go_through_slices(spark):
    df = spark.range(4_000).selectExpr("id % 2 AS g", "id")
    direct, sliced = top_n(df, ["g"], [F.col("id")], 5), top_n(df, ["g"], [F.col("id")], 1_001)
    assert sliced.count() == 2 * 1_001 and sliced.agg(F.max("id")).first()[0] == 2_001
    assert "WindowGroupLimit" in direct._jdf.queryExecution().executedPlan().toString()
    assert sliced._jdf.queryExecution().executedPlan().toString().count("Window [") >= 2


def test_unreadable_times_are_listed_and_count_as_category_actions(spark):
    records = actions(spark, dict(click_category_id="7"), dict(click_category_id="7", action_time="noon"))
    result = analyse_sessions(records, None, TaskParams(), 1, keep=False)
    assert result.category_rows.first()["click_count"] == 2
    assert [(r["action_time"], r["reason"]) for r in result.rejected.collect()] == [("noon", "time:action_time")]
    assert json.loads(result.metrics.first()[0])["total_session_count"] == 1


def test_whole_job(spark, tmp_path):
    records = actions(spark, *[
        dict(session_id=f"s{i}", user_id=i % 5, action_time=at(60 * (i % 120) + j), page_id=j,
             click_category_id=str(i % 13) if j else "") for i in range(300) for j in range(2)])
    users = spark.createDataFrame(
        [(i, "u", "n", 20 + i, "job", "city", "male" if i % 2 else "female") for i in range(5)],
        "user_id bigint, user_name string, name string, age int, professional string, city string, sex string")
    params = TaskParams.from_document({"startDate": "2024-01-01", "endDate": "2024-01-01", "sex": "male"})
    result = analyse_sessions(records, users, params, 3)
    write_analysis(result, str(tmp_path), 3)
    assert result.stored is not None
    result.close()
    metrics = json.loads(spark.read.text(f"{tmp_path}/session_metrics/task_3").first()[0])
    assert metrics["total_session_count"] == 120
    assert spark.read.parquet(f"{tmp_path}/category_rows/task_3").count() == 10
    sampled = spark.read.json(f"{tmp_path}/session_sample/task_3")
    assert set(sampled.columns) == {"session_id", "day", "hour", "record"}
    assert sampled.groupBy("day", "hour").count().count() == 2
    stored = spark.read.parquet(f"{tmp_path}/sampled_rows/task_3")
    assert stored.select("hour", "session_id").distinct().groupBy("hour").count().where("count > 5").count() == 0
    sessions = spark.read.parquet(f"{tmp_path}/category_sessions/task_3")
    assert sessions.count() == 10 and sessions.where("order_sessions = ''").count() == 10
    top = spark.read.json(f"{tmp_path}/top10_category_session/task_3")
    assert 0 < top.select("session_id").distinct().count() <= 100
