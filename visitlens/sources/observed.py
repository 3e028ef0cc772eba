"""Counts of accepted and rejected lines, taken by the pass that produces the result.

``observe`` adds an aggregate to the running job; nothing is read again. A batch gives the counts to an ``Observation``
when its result has been written. A stream reports them with the progress of each batch, and ``StreamTotals`` adds them up,
with the rows that came later than the watermark.
"""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from visitlens.sources.clicks import parse_click_lines
from visitlens.sources.schemas import ACTION_SCHEMA, CLICK_SCHEMA, columns_of
from visitlens.sources.text import parse_action_lines

ACCEPTED = "accepted"
LATE = "late"


def reasons_of(schema: str, time_column: str | None = None) -> list[str]:
    """Why a line of the schema can be rejected, first reason first."""
    reasons = ["width"]
    for name, kind in columns_of(schema):
        if kind != "string":
            reasons.append(f"number:{name}")
        if name == time_column:
            reasons.append(f"time:{name}")
    return reasons


def observe_lines(parsed: DataFrame, reasons: list[str], observation: Observation | str) -> DataFrame:
    """The good lines of ``parsed`` (with ``reason``), and counts of all its lines under their reason."""
    counts = [F.count_if(F.col("reason") == reason).alias(reason) for reason in reasons]
    seen = parsed.observe(observation, F.count_if(F.col("reason").isNull()).alias(ACCEPTED), *counts)
    return seen.where("reason IS NULL").drop("reason", "value")


def observed_actions(lines: DataFrame, observation: Observation | str) -> DataFrame:
    """Actions with ``ts``, as from ``parse_actions``."""
    return observe_lines(parse_action_lines(lines), reasons_of(ACTION_SCHEMA, "action_time"), observation)


def observed_clicks(lines: DataFrame, observation: Observation | str) -> DataFrame:
    """Clicks with ``ts``, as from ``parse_ad_click``."""
    good = observe_lines(parse_click_lines(lines), reasons_of(CLICK_SCHEMA), observation)
    return good.select(F.timestamp_millis("timestamp").alias("ts"), *[name for name, _ in columns_of(CLICK_SCHEMA)])


class StreamTotals(StreamingQueryListener):
    """Sums of observed counts over the batches of a stream, by the name of the observation.

    Add it to ``spark.streams`` before the queries start. Progress reports come a little after their batch.
    """

    def __init__(self):
        self._counts: dict[str, Counter] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        with self._change:
            for name, row in progress.observedMetrics.items():
                total = self._counts.setdefault(name, Counter())
                total.update({k: v for k, v in row.asDict().items() if v})
                if late:
                    total[LATE] += late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait_for(self, query, seconds: float = 60) -> None:
        """Until all reports of an ended query are in."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of {query.runId} was reported")

    def counts(self, name: str) -> dict[str, int]:
        with self._change:
            return dict(self._counts.get(name, {}))
