"""Real-time ad clicks: blacklist, clean clicks, running totals with top ads, sliding counts.

Four or five queries, each with its own checkpoint, which is kept over restarts:

    clicks ─┬─ detector ── blacklist table (upsert)
            └─ cleaner ─── clean clicks (one folder per batch, blacklist read anew each batch)
                             ├─ totals ─── running totals (upsert), top ads per province (upsert)
                             ├─ top ads ── with ``ranks_in_state`` these instead, kept in state: a batch reads no table
                             └─ windows ── sliding counts (append)

The detector reads the unfiltered clicks, so a listed user keeps being counted. A batch that is
repeated after a failure writes the same version again, or finds its folder published. Tables and clean
clicks carry the id of the query that writes them: a query with another checkpoint starts counting
batches anew, and is refused there instead of losing its rows to higher numbers.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from visitlens.functions.times import DATE_KEY_FORMAT
from visitlens.operators import ads
from visitlens.session import RECOMMENDED_CONF
from visitlens.sinks.upsert import compact, next_version, partition_values, read_latest, upsert, writers
from visitlens.streaming import keyed_state

# Result tables and their keys.
BLACKLIST_KEYS = ["user_id"]
BLACKLIST_SCHEMA = "user_id int, count bigint, window_end timestamp, removed boolean"
TOTALS_SCHEMA = "date string, province string, city string, ad_id int, click_count bigint"
TOP_KEYS = ["date", "province", "rank"]
TOP_SCHEMA = "date string, province string, rank int, ad_id int, click_count bigint"
CLICK_SCHEMA = "ts timestamp, timestamp bigint, province string, city string, user_id int, ad_id int"

WATERMARK = "10 minutes"
TRIGGER = "30 seconds"
COMPACT_EVERY = 50


@dataclass(frozen=True)
class AdTables:
    """Paths of the result tables below one folder."""

    root: str

    @property
    def blacklist(self) -> str:
        return f"{self.root}/black_users"

    @property
    def clean(self) -> str:
        return f"{self.root}/clean_clicks"

    @property
    def totals(self) -> str:
        return f"{self.root}/ad_real_time_state"

    @property
    def top_ads(self) -> str:
        return f"{self.root}/top5_province_ad_click_count"

    @property
    def windows(self) -> str:
        return f"{self.root}/ad_click_count_of_window"


def _compact_sometimes(spark, batch_id, path, keys, schema, **how) -> None:
    if batch_id and batch_id % COMPACT_EVERY == 0:
        compact(spark, path, keys, schema, **how)


def _latest_window():
    """A late batch that changes an earlier window only does not replace a later one."""
    return [F.col("window_end").desc_nulls_last()]


def read_blacklist(spark: SparkSession, tables: AdTables) -> DataFrame:
    """user_id and count of the users listed now."""
    rows = read_latest(spark, tables.blacklist, BLACKLIST_KEYS, BLACKLIST_SCHEMA, newest=_latest_window())
    return rows.select("user_id", "count")


def remove_users(users: DataFrame, tables: AdTables, until: str) -> None:
    """Take users (user_id) off the blacklist. Windows that end after ``until`` can list them again."""
    rows = users.select(F.col("user_id").cast("int").alias("user_id"), F.lit(None).cast("bigint").alias("count"),
                        F.lit(until).cast("timestamp").alias("window_end"), F.lit(True).alias("removed"))
    spark = users.sparkSession
    upsert(rows.distinct(), tables.blacklist, BLACKLIST_KEYS, max(0, next_version(spark, tables.blacklist) - 1),
           writer="manual")


def read_totals(spark: SparkSession, tables: AdTables) -> DataFrame:
    return read_latest(spark, tables.totals, ads.DAILY_KEYS, TOTALS_SCHEMA, partition_by="date")


def owner_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps with its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def state_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The totals as the state of the totals query holds them: those of days the watermark has not passed."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.date_format("key.window.start", DATE_KEY_FORMAT).alias("date"), "key.province", "key.city",
                        "key.ad_id", F.col("value.count").alias("click_count"))


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that the query with this checkpoint has finished."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return max(int(f.getPath().getName()) for f in files if f.getPath().getName().isdigit())


def rebuild_totals(spark: SparkSession, tables: AdTables, checkpoint: str) -> None:
    """Write the totals of the state as the version of the last finished batch. Restores the live days of a damaged
    or deleted table; the query must not be running, and goes on from there."""
    upsert(state_totals(spark, checkpoint), tables.totals, ads.DAILY_KEYS, last_batch(spark, checkpoint),
           partition_by="date", writer=owner_of(spark, checkpoint))


def _refuse_foreign(spark: SparkSession, path: str, owner: str, known: set[str]) -> None:
    others = known - {owner, "manual"}
    if others:
        raise RuntimeError(f"{path} is written by {sorted(others)}; start with that checkpoint or a new folder")


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark, over the progress reports the query still holds."""
    return sum(state.numRowsDroppedByWatermark for progress in query.recentProgress
               for state in progress.stateOperators)


def read_top_ads(spark: SparkSession, tables: AdTables) -> DataFrame:
    return read_latest(spark, tables.top_ads, TOP_KEYS, TOP_SCHEMA)


Whitelist = DataFrame | Callable[[], DataFrame] | None


def update_blacklist(
    batch: DataFrame, batch_id: int, tables: AdTables, whitelist: Whitelist, owner: str = "batch"
) -> None:
    """Add the users above the limit, unless they are on the whitelist, which a function reads anew."""
    spark = batch.sparkSession
    _refuse_foreign(spark, tables.blacklist, owner, writers(spark, tables.blacklist))
    allowed = whitelist() if callable(whitelist) else whitelist
    listed = batch if allowed is None else ads.anti_join_whitelist(batch, allowed)
    entries = ads.blacklist_entries(listed).withColumn("removed", F.lit(False))
    upsert(entries, tables.blacklist, BLACKLIST_KEYS, batch_id, writer=owner)
    _compact_sometimes(spark, batch_id, tables.blacklist, BLACKLIST_KEYS, BLACKLIST_SCHEMA, newest=_latest_window())


def publish_clean_clicks(batch: DataFrame, batch_id: int, tables: AdTables, owner: str = "batch") -> None:
    """Clicks of users that are not listed now, in a folder that appears complete or not at all."""
    spark = batch.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    final = hadoop(f"{tables.clean}/writer={owner}/batch={batch_id}")
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    known = {s.getPath().getName().split("=", 1)[1] for s in fs.globStatus(hadoop(f"{tables.clean}/writer=*")) or []}
    _refuse_foreign(spark, tables.clean, owner, known)
    if fs.exists(final):
        return
    # Names starting with an underscore are hidden from readers.
    staging = f"{tables.clean}/_staging-{owner}-{batch_id}"
    ads.anti_join_blacklist(batch, read_blacklist(spark, tables)).write.mode("overwrite").parquet(staging)
    fs.mkdirs(final.getParent())
    if not fs.rename(hadoop(staging), final):
        raise RuntimeError(f"could not publish batch {batch_id}")


def expire_clean_clicks(spark: SparkSession, tables: AdTables, keep: int) -> None:
    """Delete all but the last ``keep`` published batches, once every reader is past them. Two streams read
    the folder, so neither may clean up after itself; without this its listing grows for ever."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = hadoop(f"{tables.clean}/writer=*/batch=*")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    batches = sorted((s.getPath() for s in fs.globStatus(target) or []),
                     key=lambda p: int(p.getName().split("=")[1]))
    for old in batches[:len(batches) - keep]:
        fs.delete(old, True)


def update_totals(
    batch: DataFrame, batch_id: int, tables: AdTables, top: int | None = 5, owner: str = "batch"
) -> None:
    """Store the changed totals and, unless ``top`` is None, rank again the (date, province) groups they belong to.

    Update mode delivers changed keys only, so this ranking reads the stored totals of the touched groups. The
    totals are partitioned by date: the folders of the version just written name the dates, and only those
    are read. On a stream, ``start_top_ads`` keeps the ranks in state and reads nothing.
    """
    spark = batch.sparkSession
    _refuse_foreign(spark, tables.totals, owner, writers(spark, tables.totals))
    upsert(batch, tables.totals, ads.DAILY_KEYS, batch_id, partition_by="date", writer=owner)
    _compact_sometimes(spark, batch_id, tables.totals, ads.DAILY_KEYS, TOTALS_SCHEMA, partition_by="date")
    if top is None:
        return
    written = f"{tables.totals}/version={batch_id}/writer={owner}/full=0"
    touched = spark.read.schema(TOTALS_SCHEMA).parquet(written).select("date", "province").distinct()
    totals = totals_of_dates(spark, tables, partition_values(spark, tables.totals, batch_id, owner, "date"))
    changed = totals.join(touched, ["date", "province"], "left_semi")
    update_top_ads(ads.province_top_ads(changed, top), batch_id, tables, owner)


def update_top_ads(batch: DataFrame, batch_id: int, tables: AdTables, owner: str = "batch") -> None:
    """Store changed ranks."""
    spark = batch.sparkSession
    _refuse_foreign(spark, tables.top_ads, owner, writers(spark, tables.top_ads))
    upsert(batch, tables.top_ads, TOP_KEYS, batch_id, writer=owner)
    _compact_sometimes(spark, batch_id, tables.top_ads, TOP_KEYS, TOP_SCHEMA)


def totals_of_dates(spark: SparkSession, tables: AdTables, dates: list[str]) -> DataFrame:
    return read_latest(spark, tables.totals, ads.DAILY_KEYS, TOTALS_SCHEMA,
                       where=F.col("date").isin(dates), partition_by="date", partitions=dates)


def _start(
    writer: DataStreamWriter, trigger: dict | None, spark: SparkSession, state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a query. Its number of state partitions stays as it is at the first start on a
    checkpoint; without one given, it is the number of shuffle partitions of the session. So does its state store:
    RocksDB where the session names none or Spark's default, which keeps all state of an executor in its heap
    and cannot hold keyed state."""
    wanted = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    if spark.conf.get(keyed_state.STORE) == keyed_state.DEFAULT_STORE:
        wanted[keyed_state.STORE] = RECOMMENDED_CONF[keyed_state.STORE]
    before = {setting: spark.conf.get(setting) for setting in wanted}
    for setting, value in wanted.items():
        spark.conf.set(setting, value)
    try:
        return writer.trigger(**(trigger or {"processingTime": TRIGGER})).start()
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)


def start_detector(
    clicks: DataFrame, tables: AdTables, checkpoint: str, whitelist: Whitelist = None,
    threshold: int = ads.ABUSE_LIMIT, watermark: str = WATERMARK, trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    abusive = ads.user_click_windows(clicks.withWatermark("ts", watermark), threshold=threshold)
    return _start(
        abusive.writeStream.queryName("ad_detector").outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, i: update_blacklist(
            df, i, tables, whitelist, owner_of(df.sparkSession, checkpoint))),
        trigger, clicks.sparkSession, state_partitions,
    )


def start_cleaner(
    clicks: DataFrame, tables: AdTables, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    return _start(
        clicks.writeStream.queryName("ad_cleaner").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, i: publish_clean_clicks(df, i, tables, owner_of(df.sparkSession, checkpoint))),
        trigger, clicks.sparkSession,
    )


def clean_clicks(spark: SparkSession, tables: AdTables) -> DataFrame:
    """The published clicks as a stream. Looking files up recursively keeps the batch folders from
    becoming a column, which the first batch would add to a stream started before it."""
    reader = spark.readStream.option("recursiveFileLookup", "true").schema(CLICK_SCHEMA)
    return reader.parquet(tables.clean)


def start_totals(
    clicks: DataFrame, tables: AdTables, checkpoint: str, top: int | None = 5,
    watermark: str = WATERMARK, trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    daily = ads.ad_daily_counts(clicks.withWatermark("ts", watermark))
    return _start(
        daily.writeStream.queryName("ad_totals").outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, i: update_totals(df, i, tables, top, owner_of(df.sparkSession, checkpoint))),
        trigger, clicks.sparkSession, state_partitions,
    )


def start_top_ads(
    clicks: DataFrame, tables: AdTables, checkpoint: str, top: int = 5,
    watermark: str = WATERMARK, trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """The top ads per province from keyed state: a batch writes the ranks it changed and reads no table."""
    changes = keyed_state.province_top_changes(clicks.withWatermark("ts", watermark), top)
    return _start(
        changes.writeStream.queryName("ad_top").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, i: update_top_ads(df, i, tables, owner_of(df.sparkSession, checkpoint))),
        trigger, clicks.sparkSession, state_partitions,
    )


def start_idle_totals(
    clicks: DataFrame, path: str, checkpoint: str,
    watermark: str = WATERMARK, trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Totals after every batch that changed them, and their end after idle batches."""
    totals = keyed_state.ad_idle_totals(clicks.withWatermark("ts", watermark))
    return _start(
        totals.writeStream.queryName("ad_idle_totals").outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint),
        trigger, clicks.sparkSession, state_partitions,
    )


def start_windows(
    clicks: DataFrame, tables: AdTables, checkpoint: str,
    watermark: str = WATERMARK, trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Every (window, ad) is written once, when the watermark has passed the window. Minutes are counted
    first: a click updates one state, and a minute of an ad ten."""
    counts = ads.ad_click_windows(clicks.withWatermark("ts", watermark), panes=True)
    return _start(
        counts.writeStream.queryName("ad_windows").outputMode("append").format("parquet")
        .option("path", tables.windows).option("checkpointLocation", checkpoint),
        trigger, clicks.sparkSession, state_partitions,
    )


def start_idle_runs(
    clicks: DataFrame, path: str, checkpoint: str,
    watermark: str = WATERMARK, trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Totals that restart after idle batches; a run is written when it can no longer grow."""
    runs = ads.ad_idle_runs(clicks, watermark=watermark)
    return _start(
        runs.writeStream.queryName("ad_idle_runs").outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint),
        trigger, clicks.sparkSession, state_partitions,
    )


def start_ad_realtime(
    spark: SparkSession, clicks: DataFrame, out_dir: str, checkpoint_dir: str,
    whitelist: Whitelist = None, threshold: int = ads.ABUSE_LIMIT, trigger: dict | None = None,
    state_partitions: int | None = None, ranks_in_state: bool = False,
) -> list[StreamingQuery]:
    """Start the queries on parsed clicks (see ``parse_ad_click``)."""
    tables = AdTables(out_dir)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    clean = hadoop(tables.clean)
    clean.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(clean)

    def at(name: str) -> str:
        return f"{checkpoint_dir}/{name}"

    published = clean_clicks(spark, tables)
    how = {"trigger": trigger, "state_partitions": state_partitions}
    queries = [
        start_detector(clicks, tables, at("detector"), whitelist, threshold, **how),
        start_cleaner(clicks, tables, at("cleaner"), trigger=trigger),
        start_totals(published, tables, at("totals"), top=None if ranks_in_state else 5, **how),
        start_windows(published, tables, at("windows"), **how),
    ]
    return [*queries, start_top_ads(published, tables, at("top_ads"), **how)] if ranks_in_state else queries
