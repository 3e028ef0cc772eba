"""Keyed state with timers: totals that expire when idle, and top ads kept up as clicks arrive.

State is in RocksDB (see ``RECOMMENDED_CONF``), since Spark's default store holds one column family only; the starting
functions of ``ad_realtime`` see to it for sessions that have the default. Clicks pass to Python in Arrow batches, and each
processor handles the rows of a key as a whole; timers are event time, so a run over old data and a live one give the
same rows.

Processors are sent to Python as code, not as names to import: Spark starts one of their workers beside the driver, which
does not get the session's Python files (``addPyFile``), so it finds this module only where its search path happens to hold it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from visitlens.functions.times import DATE_KEY_FORMAT
from visitlens.operators.ads import BATCH_SECONDS, DAILY_KEYS, IDLE_BATCHES

STORE = "spark.sql.streaming.stateStore.providerClass"
DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
IDLE_SCHEMA = "batch timestamp, date string, province string, city string, ad_id int, click_count bigint, ended boolean"
CHANGED_SCHEMA = "ts timestamp, date string, province string, ad_id int, click_count bigint"
RANK_SCHEMA = "date string, province string, rank int, ad_id int, click_count bigint"
AD_SLICES = 16
_IDLE_ROW = Row("batch", *DAILY_KEYS, "click_count", "ended")

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _millis(time: datetime) -> int:
    """Times without a zone are UTC, as in the session."""
    return round(time.replace(tzinfo=time.tzinfo or timezone.utc).timestamp() * 1000)


def _time(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, timezone.utc).replace(tzinfo=None)


class IdleTotals(StatefulProcessor):
    """Running total of a key; it goes with the ``idle_batches``-th batch in a row without a click."""

    def __init__(self, batch_seconds: int, idle_batches: int):
        self.idle = idle_batches * batch_seconds * 1000
        self.batch = batch_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "click_count long, last long")

    def _timer(self, last: int) -> int:
        """When the batch that ends the run is closed."""
        return last + self.idle + self.batch

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        counts = sorted((_millis(r.batch), r.click_count) for r in rows)  # a row per batch of a day at most
        total, last = 0, None
        if self.total.exists():
            total, last = self.total.get()
            self.handle.deleteTimer(self._timer(last))
        for now, n in counts:
            if last is not None and now - last > self.idle:
                yield _IDLE_ROW(_time(last + self.idle), *key, total, True)
                total = 0
            total, last = total + n, now
            yield _IDLE_ROW(_time(now), *key, total, False)
        self.total.update((total, last))
        self.handle.registerTimer(self._timer(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        total, last = self.total.get()
        self.total.clear()
        yield _IDLE_ROW(_time(last + self.idle), *key, total, True)

    def close(self) -> None:
        pass


def ad_idle_totals(clicks: DataFrame, batch_seconds: int = BATCH_SECONDS, idle_batches: int = IDLE_BATCHES) -> DataFrame:
    """batch, date, province, city, ad_id, click_count, ended: the totals after each batch that changed them.

    ``clicks`` is a stream with a watermark. Clicks are counted per batch first, so a hot key is one row per map task and
    batch. A batch appears once the watermark has passed it. A total that has met no click for ``idle_batches`` batches ends:
    a row with the last total, marked ``ended``, in the batch that dropped it; the key then starts at 0. All live totals at
    a batch are the last rows of their keys up to it that have not ended.
    """
    counted = clicks.groupBy(F.window("ts", f"{batch_seconds} seconds"), "province", "city", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count"))
    # The event time column of the window goes on as its last microsecond.
    timed = counted.select(F.window_time("window").alias("at"), "province", "city", "ad_id", "click_count")
    seconds = F.unix_seconds("at")
    rows = timed.withColumns({
        "batch": F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(batch_seconds))),
        "date": F.date_format("at", DATE_KEY_FORMAT)})
    return rows.groupBy(*DAILY_KEYS).transformWithState(
        IdleTotals(batch_seconds, idle_batches), IDLE_SCHEMA, "append", "eventTime")


def _with_texts(rows: pd.DataFrame) -> pd.DataFrame:
    """Text columns as plain objects: pandas' own strings come in several chunks, which state operators do not take."""
    return rows.astype({c: object for c in ("date", "province", "city") if c in rows.columns})


def _best(counts: pd.DataFrame, n: int) -> pd.DataFrame:
    """The ``n`` largest counts of ads; ties go to the smaller id. An ad's counts only grow."""
    last = counts.groupby("ad_id", as_index=False)["click_count"].max()
    return last.sort_values(["click_count", "ad_id"], ascending=[False, True]).head(n)


class _TopState(StatefulProcessor):
    """A bounded list of the best ads of a key, dropped when its day is over."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.top = handle.getListState("top", "ad_id int, click_count long")
        self.day = handle.getValueState("day", "ends long")

    def _stored(self) -> pd.DataFrame:
        return pd.DataFrame([tuple(r) for r in self.top.get()] if self.top.exists() else [], columns=["ad_id", "click_count"]).astype(
            {"ad_id": "int64", "click_count": "int64"})

    def _merge(self, changed: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The list before and after."""
        before = self._stored()
        after = _best(pd.concat([before, changed[["ad_id", "click_count"]]]), self.n)
        self.top.put([(int(a), int(c)) for a, c in after.itertuples(index=False)])
        return before.reset_index(drop=True), after.reset_index(drop=True)

    def _until(self, date: str) -> None:
        if not self.day.exists():
            ends = _millis(pd.Timestamp(date) + pd.Timedelta(days=1))
            self.day.update((ends,))
            self.handle.registerTimer(ends)

    def _drop(self) -> None:
        self.top.clear()
        self.day.clear()

    def close(self) -> None:
        pass


class SliceCounts(_TopState):
    """Counts per ad of one slice of a province and day; ads among the best of the slice go on when they change."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.counts = handle.getMapState("counts", "ad_id int", "click_count long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._until(key[0])
        latest, new = None, {}
        for part in rows:
            latest = part["ts"].max() if latest is None else max(latest, part["ts"].max())
            for ad, n in part.groupby("ad_id").size().items():
                new[int(ad)] = new.get(int(ad), 0) + int(n)
        for ad in new:
            if self.counts.containsKey((ad,)):
                new[ad] += self.counts.getValue((ad,))[0]
            self.counts.updateValue((ad,), (new[ad],))
        _, after = self._merge(pd.DataFrame(new.items(), columns=["ad_id", "click_count"]))
        changed = after[after["ad_id"].isin(list(new))]
        rows = changed.assign(ts=latest, date=key[0], province=key[1])
        yield _with_texts(rows[["ts", "date", "province", "ad_id", "click_count"]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.counts.clear()
        self._drop()
        return iter(())


class ProvinceTop(_TopState):
    """The best ads of a province and day, from changes of its slices; ranks that changed go on."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._until(key[0])
        before, after = self._merge(pd.concat(list(rows)))
        changed = after[[i >= len(before) or tuple(before.loc[i]) != tuple(after.loc[i]) for i in range(len(after))]]
        rows = changed.assign(date=key[0], province=key[1], rank=changed.index + 1)
        yield _with_texts(rows[["date", "province", "rank", "ad_id", "click_count"]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._drop()
        return iter(())


def province_top_changes(clicks: DataFrame, n: int = 5, slices: int = AD_SLICES) -> DataFrame:
    """date, province, rank, ad_id, click_count: the ranks of the ``n`` most clicked ads that a batch changed.

    ``clicks`` is a stream with a watermark. A first operator keeps the counts, spread by ad over ``slices`` keys per province
    and day, and passes on an ad only if it changed and is among the best ``n`` of its slice. A second one keeps ``n`` rows
    per province and day. Counts only grow, so an ad that fell out comes back by a change of its own only, and nothing
    stored outside the state is read. State goes when the watermark has passed the day.
    """
    keyed = clicks.select("ts", F.date_format("ts", DATE_KEY_FORMAT).alias("date"), "province", "ad_id",
                          F.pmod(F.xxhash64("ad_id"), F.lit(slices)).cast("int").alias("slice"))
    changed = keyed.groupBy("date", "province", "slice").transformWithStateInPandas(
        SliceCounts(n), CHANGED_SCHEMA, "append", "eventTime", eventTimeColumnName="ts")
    return changed.groupBy("date", "province").transformWithStateInPandas(
        ProvinceTop(n), RANK_SCHEMA, "append", "eventTime")
