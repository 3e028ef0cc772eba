from datetime import date

import pytest
from pyspark.sql import functions as F

from visitlens.functions import business, numbers, text, times
from visitlens.functions.sql_names import register_sql_functions


def evaluate(spark, value, function, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(function(F.col("c"))).first()[0]


@pytest.mark.parametrize("value, empty, not_empty", [
    (None, True, False), ("", True, False), (" ", True, False), ("\t\n ", True, False),
    ("null", False, False), (" NULL ", False, False), ("Null\t", False, False),
    ("x", False, True), (" \tx", False, True), ("nullable", False, True), ("\tnull x", False, True),
])
def test_emptiness(spark, value, empty, not_empty):
    assert evaluate(spark, value, text.is_empty) is empty
    assert evaluate(spark, value, text.is_not_empty) in ([not_empty] if value is not None else [False, None])


@pytest.mark.parametrize("value, expected", [
    (",a,", "a"), ("a", "a"), (",,a,,", ",a,"), (",", ""), ("", ""),
])
def test_trim_comma(spark, value, expected):
    assert evaluate(spark, value, text.trim_comma) == expected


@pytest.mark.parametrize("value, expected", [("1", "01"), ("12", "12"), ("123", "0123"), ("", "0")])
def test_pad2(spark, value, expected):
    assert evaluate(spark, value, text.pad2) == expected


@pytest.mark.parametrize("value, expected", [
    ("a=1|k=v|b=2", "v"), ("k=v", "v"), ("k=|k=w", "w"), ("k=1|k=2", "1"), ("xk=1", None),
    ("k=a=b", None), ("k=v=", "v"), ("k", None), ("", None), (None, None), ("a=1|k=x y", "x y"),
])
def test_get_field(spark, value, expected):
    assert evaluate(spark, value, lambda c: text.get_field(c, "k")) == expected


def test_get_field_takes_names_literally_and_other_delimiters(spark):
    assert evaluate(spark, "axb=1|a.b=2", lambda c: text.get_field(c, "a.b")) == "2"
    assert evaluate(spark, "a=1;k=2;b=3", lambda c: text.get_field(c, "k", ";")) == "2"
    with pytest.raises(ValueError):
        text.get_field(F.col("c"), "k", "||")


@pytest.mark.parametrize("value, expected", [
    ("a=1|k=v|k=w", "a=1|k=new|k=w"), ("a=1", "a=1"), ("k=", "k=new"), ("k|b=2", "k=new|b=2"),
    ("k=v||", "k=new"), ("a=1||k=2", "a=1||k=new"),
])
def test_set_field(spark, value, expected):
    assert evaluate(spark, value, lambda c: text.set_field(c, "k", "new")) == expected


def test_set_field_other_delimiter_joins_by_pipe(spark):
    assert evaluate(spark, "a=1;k=2", lambda c: text.set_field(c, "k", "3", ";")) == "a=1|k=3"


def test_times(spark):
    moment = 1704067262005  # 2024-01-01 00:01:02.005
    assert evaluate(spark, moment, times.format_millis, "bigint") == "2024-01-01 00:01:02"
    parts = {p: evaluate(spark, moment, lambda c, p=p: times.date_part(c, p), "bigint")
             for p in times.DATE_PARTS}
    assert parts == dict(year=2024, month=1, day=1, hour=0, minute=1, second=2, millisecond=5)
    assert evaluate(spark, "2024-01-01 00:01:02", times.parse_millis) == moment - 5
    assert evaluate(spark, "2024-01-01T00:01", times.parse_millis) is None
    assert evaluate(spark, "2024-01-01 05:06:07", times.date_hour) == "2024-01-01_05"
    with pytest.raises(ValueError):
        times.date_part(F.col("c"), "week")


@pytest.mark.parametrize("first, second, seconds, before, after", [
    ("2024-01-01 00:00:10", "2024-01-01 00:00:00", 10, False, True),
    ("2024-01-01 00:00:00", "2024-01-02 00:00:00", -86400, True, False),
    ("2024-01-01 00:00:00", "2024-01-01 00:00:00", 0, False, False),
    ("bad", "2024-01-01 00:00:00", 0, False, False),
    (None, "2024-01-01 00:00:00", 0, False, False),
])
def test_time_comparisons(spark, first, second, seconds, before, after):
    other = F.lit(second)
    assert evaluate(spark, first, lambda c: times.seconds_between(c, other)) == seconds
    assert evaluate(spark, first, lambda c: times.is_before(c, other)) is before
    assert evaluate(spark, first, lambda c: times.is_after(c, other)) is after


def test_today_and_yesterday(spark):
    got = spark.range(1).select(times.today(), times.yesterday(), F.current_date()).first()
    assert got[0] == got[2].isoformat() and got[1] < got[0]
    assert spark.range(1).select(times.yesterday(date(2024, 3, 1))).first()[0] == "2024-02-29"


@pytest.mark.parametrize("value, expected", [(2.345, 2.35), (-2.345, -2.35), (1.005, 1.01), (2.0, 2.0)])
def test_round_half_up(spark, value, expected):
    assert evaluate(spark, value, numbers.round_half_up, "double") == expected


@pytest.mark.parametrize("value, expected", [
    (117615653.0, "117615653"), (1.5, "1.5"), (0.0, "0"), (100.0, "100"), (1234567890123.25, "1234567890123.25"),
    (0.12345, "0.123"), (-2.5, "-2.5"),
])
def test_plain_number(spark, value, expected):
    assert evaluate(spark, value, numbers.plain_number, "double") == expected


def test_area_levels(spark):
    areas = ["华东", "华南", "华北", "东北", "华中", "西南", "西北", "其它", None]
    levels = [evaluate(spark, a, business.area_level) for a in areas]
    assert levels == ["A", "A", "A", "B", "C", "C", "D", "E", "E"]


@pytest.mark.parametrize("value, expected", [
    ('{"product_type":"0"}', "自营商品"), ('{"product_type":"1"}', "第三方商品"),
    ("{}", "第三方商品"), (None, "第三方商品"),
])
def test_product_type(spark, value, expected):
    assert evaluate(spark, value, business.product_type) == expected


def test_sql_names(spark):
    register_sql_functions(spark)
    got = spark.sql("""SELECT is_not_empty(' null '), is_not_empty('a'), concat_id_name(1, 'X'),
        json_string('{"f": "v"}', 'f'), id_name_count(1, 'X', 3)""").first()
    assert tuple(got) == (False, True, "1:X", "v", "1:X:3")
