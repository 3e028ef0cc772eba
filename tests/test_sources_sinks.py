import pytest
from pyspark.sql import functions as F

from tests.helpers import actions, lines, rows
from visitlens.operators import filters as flt
from visitlens.params import TaskParams
from visitlens.session import scratch_path
from visitlens.sinks import database, files
from visitlens.sinks.upsert import compact, partition_values, read_latest, upsert, writers
from visitlens.sources import clicks as src_clicks
from visitlens.sources import tables, text
from visitlens.sources.schemas import ACTION_COLUMNS

GOOD = "2024-01-01,1,s,2,2024-01-01 08:00:00,kw,,,1|2,3|4,,,7"


def test_action_lines(spark):
    bad = {
        "2024-01-01,1,s": "width",
        GOOD + ",8": "width",
        GOOD[:-1]: "width",  # the last field is empty, so the line is a field short
        GOOD.replace(",1,s", ",one,s"): "number:user_id",
        GOOD.replace("08:00:00", "8 o'clock"): "time:action_time",
        GOOD[:-1] + "x": "number:city_id",
        GOOD.replace(",2,2024", ",99999999999999999999,2024"): "number:page_id",
        "": "width",
    }
    good, rejected = text.parse_actions(lines(spark, GOOD, GOOD + ",,", *bad))
    assert good.columns == [*ACTION_COLUMNS[:5], "ts", *ACTION_COLUMNS[5:]]
    assert rows(good, *ACTION_COLUMNS) == [
        ("2024-01-01", 1, "s", 2, "2024-01-01 08:00:00", "kw", "", "", "1|2", "3|4", "", "", 7)] * 2
    assert rows(rejected) == sorted(bad.items(), key=str)


def test_scans_of_files(spark, tmp_path):
    (tmp_path / "users").write_text("1,u1,Name,30,job,city,male\n2,u2,Name,x,job,city,male\n")
    (tmp_path / "products").write_text('1^thing^{"product_type":"0","a":1}\n2^thing\n')
    (tmp_path / "actions").write_text(GOOD + "\nbroken\n")
    users, bad_users = text.scan_user_info(spark, str(tmp_path / "users"))
    assert rows(users) == [(1, "u1", "Name", 30, "job", "city", "male")]
    assert rows(bad_users, "reason") == [("number:age",)]
    products, bad_products = text.scan_product_info(spark, str(tmp_path / "products"))
    assert rows(products) == [(1, "thing", '{"product_type":"0","a":1}')]
    assert rows(bad_products, "reason") == [("width",)]
    good, bad = text.scan_action_log(spark, str(tmp_path / "actions"))
    assert (good.count(), bad.count()) == (1, 1)


def test_click_lines(spark):
    values = {
        "1704067200005 \t p c\t \n3   4 \r": None, "1 p c 3\t4": "width", "1704067200005 p c 3": "width", "1 p c 3 4 5": "width",
        "1704067200005 p c three 4": "number:user_id", "x p c 3 4": "number:timestamp",
        "1 p c 3 4.5": "number:ad_id", "": "width",
    }
    df = lines(spark, *values)
    assert rows(src_clicks.parse_ad_click(df).withColumn("ts", F.unix_millis("ts"))) == [
        (1704067200005, 1704067200005, "p", "c", 3, 4)]
    assert rows(src_clicks.rejected_ad_clicks(df)) == sorted(
        ((v, r) for v, r in values.items() if r), key=str)


def test_topic_setting_skips_malformed_entries():
    assert src_clicks.topic_names("a:2, b : 1 ,c,d:x,:3,e:4") == ["a", "b", "e"]


def test_jdbc_arguments():
    assert tables.jdbc_slices("id", 0, 100, 4) == {
        "column": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4}
    with pytest.raises(ValueError):
        tables.jdbc_slices("id", 5, 5, 4)


class Recorder:
    """Stands for a reader or writer and keeps what it is asked to do."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self
        return call


def test_jdbc_calls():
    reader, writer = Recorder(), Recorder()
    fake_spark, fake_df = type("S", (), {"read": reader})(), type("D", (), {"write": writer})()
    tables.scan_jdbc_table(fake_spark, "jdbc:x", "city_info", slices=tables.jdbc_slices("id", 0, 9, 3))
    assert reader.calls == [("jdbc", ("jdbc:x", "city_info"), {
        "properties": {}, "column": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3})]
    database.append_to_table(fake_df, "jdbc:x", "t", {"user": "u"})
    assert writer.calls == [("option", ("batchsize", 500), {}),
                            ("jdbc", ("jdbc:x", "t"), {"mode": "append", "properties": {"user": "u"}})]


def test_merge_statement():
    assert database.merge_statement("t", "s", ["k"], ["v", "w"]) == (
        'MERGE INTO "t" t USING "s" s ON t."k" = s."k" WHEN MATCHED THEN UPDATE SET "v" = s."v", "w" = s."w"'
        ' WHEN NOT MATCHED THEN INSERT ("k", "v", "w") VALUES (s."k", s."v", s."w")')
    assert database.merge_statement("a.t", "s", ['x"; DROP'], []).startswith('MERGE INTO "a"."t" t USING "s" s ON t."x""; DROP" =')


def test_filters_by_task(spark):
    records = actions(
        spark, dict(date="2024-01-01", user_id=1), dict(date="2024-01-02", user_id=2, search_keyword="kw"),
        dict(date="2024-01-03", user_id=3, order_category_ids="4|5"), dict(date="2024-01-04", user_id=9))
    users = spark.createDataFrame(
        [(1, "u", "n", 20, "teacher", "rome", "male"), (2, "u", "n", 30, "doctor", "oslo", "female"),
         (3, "u", "n", 40, "doctor", "rome", "male")],
        "user_id bigint, user_name string, name string, age int, professional string, city string, sex string")

    def kept(document, users=users):
        found = flt.filter_actions_by_task(records, users, TaskParams.from_document(document))
        assert found.columns == records.columns
        return [r[0] for r in rows(found, "user_id")]

    assert kept({"startDate": "2024-01-02", "endDate": "2024-01-03"}, None) == [2, 3]
    assert kept({"x": 1}) == [1, 2, 3, 9]
    assert kept({"sex": "male"}) == [1, 3]
    assert kept({"professionals": ","}) == [1, 2, 3, 9]
    assert kept({"professionals": "doctor", "cities": "rome"}) == [3]
    assert kept({"startAge": 25}) == [2, 3]
    assert kept({"endAge": 30, "startAge": 20}) == [1, 2]
    assert kept({"keywords": "kw,other"}) == [2]
    assert kept({"categoryIds": "5,6"}) == [3]
    with pytest.raises(ValueError):
        kept({"sex": "male"}, None)


def test_users_are_joined_only_if_filtered(spark):
    records = actions(spark, dict(user_id=1))
    users = spark.createDataFrame([(1, "male")], "user_id bigint, sex string")
    plan = flt.filter_actions_by_task(records, users, TaskParams(start_date="2024-01-01"))
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_parameter_filters(spark):
    df = spark.createDataFrame(
        [(1, "age=20|job=a,b"), (2, "age=31|job=c"), (3, "job=a"), (4, "age=x|job=")], "id int, data string")

    def ids(found):
        return [r[0] for r in rows(found, "id")]

    assert ids(flt.filter_between_param(df, "data", "age", "from=20|to=30", "from", "to")) == [1]
    assert ids(flt.filter_between_param(df, "data", "age", "from=20", "from", "to")) == [1, 2, 3, 4]
    assert ids(flt.filter_in_param(df, "data", "job", "jobs=b,c", "jobs")) == [1, 2]
    assert ids(flt.filter_in_param(df, "data", "job", "other=b", "jobs")) == [1, 2, 3, 4]
    assert ids(flt.filter_equal_param(df, "data", "job", "j=a", "j")) == [3]
    assert ids(flt.filter_equal_param(df, "data", "job", "", "j")) == [1, 2, 3, 4]


def test_catalog_scan(spark):
    actions(spark, dict(city_id=1), dict(city_id=2)).createOrReplaceTempView("some_actions")
    df = tables.scan_catalog_table(spark, "some_actions", ["city_id"], F.col("city_id") > 1)
    assert rows(df) == [(2,)]


def test_document_sinks_replace(spark, tmp_path):
    path = str(tmp_path / "out")
    for value in ("first", "second"):
        files.write_json_lines(lines(spark, value), path)
    assert [r[0] for r in spark.read.text(path).collect()] == ['{"value":"second"}']
    files.write_document_lines(lines(spark, "{}"), "value", path)
    assert [r[0] for r in spark.read.text(path).collect()] == ["{}"]


SCHEMA = "k int, v string, n bigint"


def batch(spark, *data):
    return spark.createDataFrame(data, SCHEMA)


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "table")
    assert rows(read_latest(spark, path, ["k"], SCHEMA)) == []
    # Two rows of one key in a batch: the order given decides.
    upsert(batch(spark, (1, "old", 1), (1, "new", 2), (2, "x", 1)), path, ["k"], 0, order_by=[F.col("n").desc()])
    assert rows(read_latest(spark, path, ["k"], SCHEMA)) == [(1, "new", 2), (2, "x", 1)]
    upsert(batch(spark, (1, "later", 0), (3, "y", 1)), path, ["k"], 1)
    expected = [(1, "later", 0), (2, "x", 1), (3, "y", 1)]
    assert rows(read_latest(spark, path, ["k"], SCHEMA)) == expected
    # A repeated batch replaces itself.
    upsert(batch(spark, (1, "later", 0), (3, "y", 1)), path, ["k"], 1)
    assert rows(read_latest(spark, path, ["k"], SCHEMA)) == expected


def test_compaction_keeps_the_current_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    for version in range(3):
        upsert(batch(spark, (1, f"v{version}", version), (version + 10, "x", 0)), path, ["k"], version)
    before = rows(read_latest(spark, path, ["k"], SCHEMA))
    compact(spark, path, ["k"], SCHEMA)
    compact(spark, path, ["k"], SCHEMA)
    assert rows(read_latest(spark, path, ["k"], SCHEMA)) == before
    upsert(batch(spark, (1, "last", 9)), path, ["k"], 3)
    compact(spark, path, ["k"], SCHEMA)
    assert rows(read_latest(spark, path, ["k"], SCHEMA)) == [
        (1, "last", 9), (10, "x", 0), (11, "x", 0), (12, "x", 0)]
    assert sorted(p.name for p in (tmp_path / "table").iterdir()) == ["version=2", "version=3"]


def test_partitioned_upsert_reads_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "table")
    upsert(batch(spark, (1, "a", 1), (2, "b", 1)), path, ["k", "v"], 0, partition_by="v")
    assert partition_values(spark, path, 0, "batch", "v") == ["a", "b"]
    latest = read_latest(spark, path, ["k", "v"], SCHEMA, where=F.col("v").isin(["b"]), partition_by="v")
    assert rows(latest) == [(2, "b", 1)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "v" in filters and "(v#" in filters and "= b)" in filters


def test_a_fold_leaves_untouched_partitions_alone(spark, tmp_path):
    path, keys = str(tmp_path / "table"), ["k", "v"]
    for version, part in enumerate("aabbcc"):
        upsert(batch(spark, (1, part, version), (10 + version, part, 0)), path, keys, version, partition_by="v")
        if version % 2:
            compact(spark, path, keys, SCHEMA, partition_by="v")
    folded = {p.parent.parent.parent.name: p.name for p in (tmp_path / "table").glob("version=*/writer=fold/full=1/v=*")}
    assert folded == {"version=1": "v=a", "version=3": "v=b", "version=5": "v=c"}
    assert rows(read_latest(spark, path, keys, SCHEMA, partition_by="v")) == [
        (1, "a", 1), (1, "b", 3), (1, "c", 5), (10, "a", 0), (11, "a", 0), (12, "b", 0), (13, "b", 0), (14, "c", 0),
        (15, "c", 0)]


def test_writers_of_one_version_do_not_erase_each_other(spark, tmp_path):
    path = str(tmp_path / "table")
    upsert(batch(spark, (1, "a", 1)), path, ["k"], 0, writer="x")
    upsert(batch(spark, (2, "b", 1)), path, ["k"], 0, writer="y")
    assert rows(read_latest(spark, path, ["k"], SCHEMA)) == [(1, "a", 1), (2, "b", 1)]
    assert writers(spark, path) == {"x", "y"}


def test_removed_keys_are_gone_also_after_a_fold(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "k int, removed boolean"
    upsert(spark.createDataFrame([(1, False), (2, False)], schema), path, ["k"], 0)
    upsert(spark.createDataFrame([(1, True)], schema), path, ["k"], 1)
    assert rows(read_latest(spark, path, ["k"], schema), "k") == [(2,)]
    compact(spark, path, ["k"], schema)
    assert rows(read_latest(spark, path, ["k"], schema), "k") == [(2,)]


def test_without_a_shared_folder_there_is_an_error(spark, monkeypatch):
    import visitlens.session

    monkeypatch.setattr(visitlens.session, "shared_folder", lambda s: None)
    with pytest.raises(RuntimeError):
        visitlens.session.scratch_path(spark, "x")


def test_scratch_path_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from visitlens.operators.products import area_product_count, product_clicks

    path = str(tmp_path / "actions")
    actions(spark, dict(click_product_id="7")).write.partitionBy("date").parquet(path)
    cities = spark.createDataFrame([(1, "X", "A")], "city_id int, city_name string, area string")
    stored = spark.read.parquet(path)
    counts = area_product_count(product_clicks(stored, "2024-01-01", "2024-01-02"), cities)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<click_product_id:string,city_id:int>" in scan
    assert "date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "IsNotNull(city_id)" in scan
