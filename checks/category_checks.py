"""Category rankings."""

from __future__ import annotations

from checks import views
from checks.registry import check
from checks.session_checks import _RECORD, job_result
from visitlens.operators import categories as cat
from visitlens.operators import documents as doc


def _exploded(spark, sf):
    return cat.explode_category_actions(views.actions(spark, sf))


def _top_sessions(spark, sf):
    exploded = _exploded(spark, sf)
    return cat.top_category_sessions(exploded, cat.top_categories(exploded))


PIVOT = """
SELECT category_id, CAST(coalesce(max(cnt) FILTER (WHERE flag = 0), 0) AS BIGINT) AS click_count,
  CAST(coalesce(max(cnt) FILTER (WHERE flag = 1), 0) AS BIGINT) AS order_count,
  CAST(coalesce(max(cnt) FILTER (WHERE flag = 2), 0) AS BIGINT) AS pay_count
FROM {source} GROUP BY category_id"""

check("explode_category_actions", "exploded",
      "SELECT session_id, category_id, flag FROM exploded")(_exploded)


@check("category_action_counts", "category_counts",
       "SELECT category_id, flag, cnt FROM category_counts")
def category_action_counts(spark, sf):
    return cat.category_action_counts(_exploded(spark, sf))


@check("category_pivot", "category_counts", PIVOT.format(source="category_counts"))
def category_pivot(spark, sf):
    return cat.category_pivot(cat.category_action_counts(_exploded(spark, sf)))


@check("top10_categories", "category_tops", PIVOT.format(source="category_tops"))
def top10_categories(spark, sf):
    return cat.top_categories(_exploded(spark, sf))


@check("top10_categories_full_counts", "category_tops", PIVOT.format(
    source="category_counts WHERE category_id IN (SELECT category_id FROM category_tops)"))
def top10_categories_full_counts(spark, sf):
    return cat.top_categories(_exploded(spark, sf), full_counts=True)


@check("semi_join_broadcast", "category_tops", """
SELECT session_id, category_id, flag FROM exploded
WHERE category_id IN (SELECT category_id FROM category_tops)""")
def semi_join_broadcast(spark, sf):
    exploded = _exploded(spark, sf)
    return cat.only_categories(exploded, cat.top_categories(exploded)).select("session_id", "category_id", "flag")


@check("session_category_counts", "category_tops", """
SELECT category_id, flag, session_id, count(*) AS cnt FROM exploded
WHERE category_id IN (SELECT category_id FROM category_tops)
GROUP BY category_id, flag, session_id""")
def session_category_counts(spark, sf):
    exploded = _exploded(spark, sf)
    return cat.session_category_counts(exploded, cat.top_categories(exploded))


check("top10_category_sessions", "category_top_sessions",
      "SELECT category_id, flag, session_id, cnt FROM category_top_sessions")(_top_sessions)


@check("top_session_details", "category_top_sessions", f"""
SELECT {_RECORD} AS document FROM actions
WHERE session_id IN (SELECT session_id FROM category_top_sessions)""")
def top_session_details(spark, sf):
    details = cat.top_session_details(views.actions(spark, sf), _top_sessions(spark, sf))
    return doc.action_json(details)


ARRAY = """coalesce('[' || string_agg('{{"sessionid":"' || session_id || '","count":' || cnt || '}}', ','
  ORDER BY cnt, session_id) FILTER (WHERE flag = {flag}) || ']', '') AS {name}_sessions"""


@check("category_sessions_json", "category_top_sessions",
       "SELECT category_id, " + ", ".join(
           ARRAY.format(flag=flag, name=name) for flag, name in cat.FLAG_NAMES.items())
       + " FROM category_top_sessions GROUP BY category_id")
def category_sessions_json(spark, sf):
    return doc.category_sessions_json(_top_sessions(spark, sf))


# The rows given to the database writer; the insert itself needs a database, which may not be started here.
@check("top10_category_rows", "category_tops",
       PIVOT.format(source="category_tops").replace("SELECT", "SELECT CAST(7 AS BIGINT) AS task_id,", 1))
def top10_category_rows(spark, sf):
    return doc.top_category_rows(cat.top_categories(_exploded(spark, sf)), 7)


job_result("category_rows", "category_tops",
           PIVOT.format(source="category_tops").replace("SELECT", "SELECT CAST(7 AS BIGINT) AS task_id,", 1))
job_result("category_sessions", "category_top_sessions",
           "SELECT category_id, " + ", ".join(ARRAY.format(flag=f, name=n) for f, n in cat.FLAG_NAMES.items())
           + " FROM category_top_sessions GROUP BY category_id")
job_result("category_records", "category_top_sessions", f"""
SELECT {_RECORD} AS document FROM actions
WHERE session_id IN (SELECT session_id FROM category_top_sessions)""")
