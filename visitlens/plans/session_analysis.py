"""Session analysis: metrics, a sample per hour, top categories and their top sessions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from visitlens.operators import categories as cat
from visitlens.operators import documents as doc
from visitlens.operators import sampling as smp
from visitlens.operators import sessions as ses
from visitlens.operators.filters import filter_actions_by_task
from visitlens.params import TaskParams
from visitlens.session import delete_path, write_shared
from visitlens.sinks.files import write_document_lines
from visitlens.sources.tables import with_time, without_time

TOP_HOUR_SESSIONS = 5


@dataclass
class SessionAnalysis:
    metrics: DataFrame           # one JSON document
    sampled_records: DataFrame   # JSON per action
    sampled_rows: DataFrame      # task_id, session_id, day, hour, record
    category_rows: DataFrame     # task_id, category_id, click_count, order_count, pay_count
    category_sessions: DataFrame  # category_id and three JSON arrays
    category_records: DataFrame  # JSON per action of the top sessions
    rejected: DataFrame          # actions whose time cannot be read, which no result by time has
    kept: list[DataFrame]        # persisted intermediate results
    stored: str | None           # path of the filtered actions, if they were written

    def release(self) -> None:
        """Give up the persisted results; what was filtered and written stays until ``close``."""
        for df in self.kept:
            df.unpersist()
        self.kept.clear()

    def close(self) -> None:
        self.release()
        if self.stored:
            delete_path(self.metrics.sparkSession, self.stored)


def analyse_sessions(
    actions: DataFrame, users: DataFrame | None, p: TaskParams, task_id: int, keep: bool = True
) -> SessionAnalysis:
    """All results as DataFrames; call ``close`` after using them.

    The results scan the actions separately, each with only the columns it needs. What they
    share is kept (``keep``) where it is small: the (session, hour) aggregate, at most 30
    categories and 900 sessions. Persisted parts that are lost with an executor are computed
    again. If users are filtered, the join is done once and the remaining actions are written to
    the shared folder, instead of being joined again for every result.
    """
    all_chosen, stored = filter_actions_by_task(actions, users, p), None
    if keep and p.needs_users:
        all_chosen, stored = write_shared(all_chosen, "actions")
    chosen = with_time(all_chosen)
    kept: list[DataFrame] = []

    def shared(df: DataFrame) -> DataFrame:
        if keep:
            kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    hours = shared(ses.session_hours(chosen))
    hourly, sessions = ses.hours_to_hourly(hours), ses.hours_to_sessions(hours)

    detail = smp.sampled_actions(chosen, hourly, p.session_ratio, p.sample_type)
    # The number of actions of a sampled session is known from the hour aggregate already.
    sample = smp.sample_sessions(hourly, p.session_ratio, p.sample_type, extra=("n_actions",))
    top_hour = smp.rank_hour_sessions(sample, TOP_HOUR_SESSIONS)

    # Categories need no time, so they are counted over all chosen actions.
    exploded = cat.explode_category_actions(all_chosen)
    categories = shared(cat.top_categories(exploded))
    top_sessions = shared(cat.top_category_sessions(exploded, categories))
    records = cat.top_session_details(all_chosen, top_sessions)

    return SessionAnalysis(
        metrics=doc.session_aggr_json(sessions, hourly),
        sampled_records=doc.sample_record_json(detail),
        sampled_rows=doc.sample_session_rows(smp.with_hour(chosen), top_hour, task_id),
        category_rows=doc.top_category_rows(categories, task_id),
        category_sessions=doc.category_sessions_json(top_sessions),
        category_records=doc.action_json(records),
        rejected=without_time(all_chosen),
        kept=kept,
        stored=stored,
    )


def write_analysis(result: SessionAnalysis, out_dir: str, task_id: int) -> None:
    """Write all parts below ``out_dir``: JSON lines for records, parquet for rows."""
    write_document_lines(result.metrics, "document", f"{out_dir}/session_metrics/task_{task_id}")
    write_document_lines(result.sampled_records, "document", f"{out_dir}/session_sample/task_{task_id}")
    write_document_lines(
        result.category_records, "document", f"{out_dir}/top10_category_session/task_{task_id}")
    for name in ("sampled_rows", "category_rows", "category_sessions", "rejected"):
        getattr(result, name).write.mode("overwrite").parquet(f"{out_dir}/{name}/task_{task_id}")
