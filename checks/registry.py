"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Views over the given tables, as SQL. Times are UTC; a session is one user and day.
_VIEWS = {
    "actions": """
  SELECT d AS date, user_id, concat(user_id, '_', d) AS session_id, event_id % 302 AS page_id,
    t AS action_time,
    CASE WHEN event_type = 'view' THEN concat('kw_', k % 10) ELSE '' END AS search_keyword,
    CASE WHEN event_type = 'click' THEN concat(k, '') ELSE '' END AS click_category_id,
    CASE WHEN event_type = 'click' THEN concat(2 * k, '') ELSE '' END AS click_product_id,
    CASE WHEN event_type = 'purchase' THEN concat(k, '|', (k + 7) % 100) ELSE '' END AS order_category_ids,
    CASE WHEN event_type = 'purchase' THEN concat(2 * k, '|', 2 * ((k + 7) % 100)) ELSE '' END AS order_product_ids,
    CASE WHEN event_type = 'signup' THEN concat(k, '') ELSE '' END AS pay_category_ids,
    CASE WHEN event_type = 'signup' THEN concat(2 * k, '') ELSE '' END AS pay_product_ids,
    CAST(user_id % 25 AS INTEGER) AS city_id, sec, d AS day, CAST(hour(ts) AS INTEGER) AS hour
  FROM (SELECT event_id, user_id, event_type, ts, date_trunc('second', ts) AS sec,
          CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
          strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t
        FROM events) e""",
    "user_info": """
  SELECT c_custkey AS user_id, concat('user_', c_custkey) AS user_name, c_name AS name,
    CAST(15 + c_custkey % 45 AS INTEGER) AS age, c_mktsegment AS professional, n_name AS city,
    CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "city_info": """
  SELECT n_nationkey AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "product_info": """
  SELECT p_partkey AS product_id, p_name AS product_name,
    concat('{"product_type":"', p_size % 2, '"}') AS extend_info
  FROM part""",
    "clicks": """
  SELECT date_trunc('millisecond', ts) AS ts, epoch_us(ts) // 1000 AS timestamp,
    concat('province_', user_id % 5) AS province, concat('city_', user_id % 25) AS city,
    CAST(user_id AS INTEGER) AS user_id,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS ad_id
  FROM events""",
    # Products clicked in orders: one click per order line, from the city of the customer.
    "order_clicks": """
  SELECT c_nationkey AS city_id, CAST(l_partkey AS VARCHAR) AS click_product_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    # One row per session, and one per session and hour.
    "sessions": """
  SELECT session_id, count(*) AS n_actions,
    CAST(epoch(max(sec)) - epoch(min(sec)) AS BIGINT) AS len FROM actions GROUP BY session_id""",
    "hourly": """
  SELECT session_id, day, hour, count(*) AS n_actions,
    CAST(1000 * (epoch(max(sec)) - epoch(min(sec))) AS BIGINT) AS length_ms
  FROM actions GROUP BY session_id, day, hour""",
    # One row per touched category.
    "exploded": """
  SELECT session_id, category_id, flag FROM (
    SELECT session_id, click_category_id AS category_id, 0 AS flag FROM actions
    WHERE trim(click_category_id) <> ''
    UNION ALL
    SELECT session_id, unnest(string_split(order_category_ids, '|')), 1 FROM actions
    WHERE trim(click_category_id) = '' AND trim(order_category_ids) <> ''
    UNION ALL
    SELECT session_id, unnest(string_split(pay_category_ids, '|')), 2 FROM actions
    WHERE trim(click_category_id) = '' AND trim(order_category_ids) = '' AND trim(pay_category_ids) <> ''
  ) WHERE trim(category_id) <> ''""",
    "category_counts": """
  SELECT category_id, flag, count(*) AS cnt FROM exploded GROUP BY category_id, flag""",
    "category_tops": """
  SELECT category_id, flag, cnt FROM (
    SELECT *, row_number() OVER (PARTITION BY flag ORDER BY cnt DESC, category_id) AS rn
    FROM category_counts) WHERE rn <= 10""",
    "category_top_sessions": """
  SELECT category_id, flag, session_id, cnt FROM (
    SELECT *, row_number() OVER (PARTITION BY category_id, flag ORDER BY cnt DESC, session_id) AS rn
    FROM (SELECT category_id, flag, session_id, count(*) AS cnt FROM exploded
          WHERE category_id IN (SELECT category_id FROM category_tops)
          GROUP BY category_id, flag, session_id)) WHERE rn <= 10""",
    # Sampling: key, probability 0.05 (0x0ccccccc of 32 bits) and the need per hour.
    "keyed": """
  SELECT *, md5(concat_ws('|', session_id, day, hour, 42)) AS key FROM hourly""",
    "need": """
  SELECT day, hour, least(greatest(3, floor(count(*) * CAST(0.05 AS DOUBLE))), 50) AS need
  FROM hourly GROUP BY day, hour""",
    "topup": """
  SELECT session_id, day, hour FROM (
    SELECT *, row_number() OVER (PARTITION BY day, hour ORDER BY key) AS rn FROM keyed
  ) JOIN need USING (day, hour) WHERE rn <= need AND key >= '0ccccccc'""",
    "sample": """
  SELECT session_id, day, hour FROM keyed WHERE key < '0ccccccc'
  UNION ALL SELECT session_id, day, hour FROM topup""",
    "detail": """
  SELECT a.* FROM actions a JOIN sample s
    ON a.session_id = s.session_id AND a.day = s.day AND a.hour = s.hour""",
    "user_windows": """
  SELECT w AS window_start, w + INTERVAL 10 MINUTE AS window_end, user_id, count(*) AS click_count
  FROM (SELECT user_id, unnest(range(
          time_bucket(INTERVAL 3 MINUTE, ts, TIMESTAMP '1970-01-01') - INTERVAL 9 MINUTE,
          time_bucket(INTERVAL 3 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 MINUTE,
          INTERVAL 3 MINUTE)) AS w, ts FROM clicks)
  WHERE ts < w + INTERVAL 10 MINUTE GROUP BY w, user_id""",
    "abusive": """
  SELECT * FROM user_windows WHERE click_count > 1 AND user_id >= 100""",
    "blacklist": """
  SELECT user_id, click_count AS count FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY window_end DESC) AS rn FROM abusive
  ) WHERE rn = 1""",
    "daily": """
  SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id, count(*) AS click_count
  FROM clicks GROUP BY ALL""",
}

_NEEDS = {
    "sessions": ["actions"], "hourly": ["actions"], "exploded": ["actions"],
    "category_counts": ["exploded"], "category_tops": ["category_counts"],
    "category_top_sessions": ["category_tops"], "keyed": ["hourly"], "need": ["hourly"],
    "topup": ["keyed", "need"], "sample": ["topup"], "detail": ["sample"],
    "user_windows": ["clicks"], "abusive": ["user_windows"], "blacklist": ["abusive"],
    "daily": ["clicks"],
}


def sql_with(views: str, body: str, only: str = "") -> str:
    """``body`` after WITH clauses for the named views and what they build on.

    ``only`` is a condition on actions and their users (``u``); the views then see no other actions.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        add(name)
    if not ordered:
        return body
    texts = {n: _VIEWS[n] for n in ordered}
    if only:
        chosen = f"SELECT a.* FROM all_actions a JOIN user_info u USING (user_id) WHERE {only}"
        texts = {"all_actions": texts.pop("actions"), "user_info": _VIEWS["user_info"], "actions": chosen, **texts}
    views_text = "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in texts.items())
    own = body.strip()
    return f"{views_text},\n{own[5:]}" if own.startswith("WITH ") else f"{views_text}\n{own}"


def check(name: str, views: str = "", sql: str | None = None, only: str = ""):
    """Register a query; without ``sql`` only its rows are checked."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql_with(views, sql, only)
        return function

    return register
