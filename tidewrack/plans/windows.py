"""Window, sorting and event-time queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.windows import over_groups, qualify, sessions
from .query import query, same_sql

same_sql(
    "window_ranks",
    "SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS dr, round(percent_rank() OVER w, 9) AS pr, round(cume_dist() OVER w, 9) AS cd, "
    "CAST(ntile(4) OVER w AS INT) AS nt FROM {orders} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)",
    "SELECT o_orderkey, row_number() OVER w::INT AS rn, rank() OVER w::INT AS rk, dense_rank() OVER w::INT AS dr, round(percent_rank() OVER w, 9) AS pr, round(cume_dist() OVER w, 9) AS cd, "
    "ntile(4) OVER w::INT AS nt FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)".replace("() OVER w::INT", "() OVER w").replace("(4) OVER w::INT", "(4) OVER w"),
)
same_sql(
    "window_offsets",
    "SELECT event_id, lag(value, 1) OVER w AS before, lead(value, 2) OVER w AS after, first_value(value) OVER w AS first_v, nth_value(value, 2) OVER w AS second_v FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
)
same_sql(
    "window_rows_frame",
    "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS n, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS top FROM {events}",
)
same_sql(
    "window_range_frame",
    "SELECT p_partkey, count(*) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS n FROM {part}",
)
same_sql("window_running_total", "SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE) AS total FROM {orders}")
same_sql("sort_top", "SELECT l_orderkey, l_extendedprice, l_partkey FROM {lineitem} ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_partkey LIMIT 25")
same_sql("sort_offset", "SELECT p_partkey, p_name FROM {part} ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 10 OFFSET 15")


@query("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderpriority GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM orders")
def window_groups_frame(t):
    return over_groups(t.orders, ["o_custkey"], "o_orderpriority", 1, 0, F.count("*"), "n").select("o_orderkey", "n")


@query("SELECT o_orderkey FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) = 1")
def window_qualify(t):
    rank = F.rank().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice")))
    return qualify(t.orders, rank, lambda v: v == 1).select("o_orderkey")


@query("SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_time_tumbling(t):
    rows = t.events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return rows.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("""
SELECT strftime(b, '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR, time_bucket(INTERVAL 6 HOUR, ts)]) AS b FROM events) GROUP BY ALL""")
def event_time_sliding(t):
    rows = t.events.groupBy(F.window("ts", "12 hours", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return rows.select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("start"), "n")


_OPENED = """
SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS session FROM
(SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR THEN 1 WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS opens FROM events)"""
_SESSIONS = f"SELECT user_id, session, count(*) AS n FROM ({_OPENED}) GROUP BY user_id, session"


@query(_SESSIONS)
def event_time_sessions(t):
    return sessions(t.events, ["user_id"], "ts", "12 HOURS").groupBy("user_id", "session").agg(F.count("*").alias("n"))


@query(f"SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM ({_OPENED}) GROUP BY user_id, session")
def event_time_session_window(t):
    """Spark's session_window, like `sessions`, goes on over a pause of exactly the gap (a test holds both to that)."""
    rows = t.events.groupBy("user_id", F.session_window("ts", "12 hours").alias("w")).agg(F.count("*").alias("n"))
    return rows.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")
