"""Join and subquery queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import asof_join, range_join, salted_join, top_per_key
from .query import query, same_sql


@query("""
SELECT c_custkey, c_name, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING' GROUP BY c_custkey, c_name ORDER BY revenue DESC, c_custkey LIMIT 10""")
def top_customers_by_revenue(t):
    """Ten customers of one market segment with the largest revenue."""
    customer = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    revenue = F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)"))
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("c_custkey", "c_name").agg(revenue.cast("double").alias("revenue")).orderBy(F.desc("revenue"), "c_custkey").limit(10)


@query("SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def join_small_side(t):
    """Nations have 25 rows, which Spark sends to the tasks by itself after checking their size."""
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("suppliers"))


_BY_STATUS = "SELECT o_orderstatus, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"


def _by_status(t, hint):
    rows = t.lineitem.hint(hint).join(t.orders.hint(hint), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("o_orderstatus", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


query(_BY_STATUS, "join_sort_merge")(lambda t: _by_status(t, "merge"))
query(_BY_STATUS, "join_shuffle_hash")(lambda t: _by_status(t, "shuffle_hash"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT c_custkey) AS customers FROM events JOIN customer ON user_id = c_custkey GROUP BY event_type")
def join_salted(t):
    rows = salted_join(t.events.select("event_id", "event_type", F.col("user_id").alias("c_custkey")), t.customer.select("c_custkey"), "c_custkey", 8)
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("c_custkey").alias("customers"))


_TOTALS = "SELECT event_id, c_custkey, c_name FROM (SELECT event_id, user_id FROM events) {how} JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey"


def _salted_outer(t, how):
    large = t.events.select("event_id", F.col("user_id").alias("k"))
    small = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), "c_custkey", "c_name")
    return salted_join(large, small, "k", 8, how).select("event_id", "c_custkey", "c_name")


for _how in ("left", "right", "full"):
    query(_TOTALS.replace("{how}", _how.upper()), f"join_salted_{_how}")(lambda t, how=_how: _salted_outer(t, how))

_KEYS = "(SELECT o_custkey AS k, count(*) AS orders FROM {orders} WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)"
_CUST = "(SELECT c_custkey AS k, c_nationkey FROM {customer} WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))"
for _how in ("LEFT", "RIGHT", "FULL"):
    same_sql(f"join_{_how.lower()}_outer", f"SELECT coalesce(a.k, b.k) AS k, c_nationkey, orders FROM {_CUST} a {_how} JOIN {_KEYS} b ON a.k = b.k")
same_sql("join_semi", "SELECT c_custkey FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
same_sql("join_anti", "SELECT c_custkey FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
same_sql("join_not_in", "SELECT p_partkey FROM {part} WHERE p_partkey NOT IN (SELECT l_partkey FROM {lineitem} WHERE l_quantity >= 40)")
same_sql("join_cross_small", "SELECT r_name, n_name FROM {region} CROSS JOIN {nation} WHERE r_regionkey <> n_regionkey")
same_sql("join_using", "SELECT count(*) AS n FROM (SELECT l_orderkey AS k FROM {lineitem}) a JOIN (SELECT o_orderkey AS k FROM {orders}) b USING (k)")
same_sql("join_self", "SELECT a.o_orderkey, count(*) AS later FROM {orders} a JOIN {orders} b ON a.o_custkey = b.o_custkey AND a.o_orderdate < b.o_orderdate GROUP BY a.o_orderkey")
same_sql(
    "join_star",
    "SELECT r_name, year(o_orderdate) AS y, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey "
    "JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey JOIN {part} ON l_partkey = p_partkey "
    "WHERE p_size < 20 GROUP BY r_name, year(o_orderdate)",
)
same_sql("subquery_scalar", "SELECT s_suppkey FROM {supplier} WHERE s_acctbal > (SELECT avg(s_acctbal) FROM {supplier})")
same_sql("subquery_correlated", "SELECT o_orderkey FROM {orders} o WHERE o_totalprice > (SELECT 1.5 * avg(o_totalprice) FROM {orders} i WHERE i.o_custkey = o.o_custkey)")
same_sql("subquery_in", "SELECT o_orderkey FROM {orders} WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_acctbal < 0)")


@query("SELECT s_suppkey FROM supplier s WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = s_nationkey AND c_acctbal > s_acctbal + 5000)")
def subquery_theta_exists(t):
    """Some customer of the nation has more exactly if the one with the most has: a row per nation, where a join would compare all pairs."""
    most = t.customer.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("most"))
    return t.supplier.join(most, (F.col("c_nationkey") == F.col("s_nationkey")) & (F.col("most") > F.col("s_acctbal") + 5000)).select("s_suppkey")


same_sql(
    "cte_reused",
    "WITH q AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey) SELECT a.o_custkey FROM q a WHERE a.n > (SELECT avg(n) FROM q)",
)
same_sql(
    "cte_recursive",
    "WITH RECURSIVE days(d, n) AS (SELECT 0, count(*) FROM {nation} UNION ALL SELECT d + 1, n FROM days WHERE d < 20) SELECT d, CAST(n AS BIGINT) AS n FROM days",
)


@query("SELECT event_id, count(l_orderkey) AS orders FROM events JOIN (SELECT o_orderkey AS l_orderkey, o_totalprice AS low, o_totalprice + 25 AS high FROM orders) ON value * 1000 BETWEEN low AND high GROUP BY event_id")
def join_range(t):
    points = t.events.select("event_id", (F.col("value") * 1000).alias("point"))
    spans = t.orders.select("o_orderkey", F.col("o_totalprice").alias("low"), (F.col("o_totalprice") + 25).alias("high"))
    return range_join(points, spans, "point", "low", "high", 100.0).groupBy("event_id").agg(F.count("o_orderkey").alias("orders"))


_RANGE_OUTER = """
SELECT event_id, o_orderkey FROM (SELECT event_id, value * 1000 AS point FROM events) {how} JOIN
(SELECT o_orderkey, o_totalprice AS low, o_totalprice + 25 AS high FROM orders) ON point BETWEEN low AND high"""


def _range_outer(t, how):
    points = t.events.select("event_id", (F.col("value") * 1000).alias("point"))
    spans = t.orders.select("o_orderkey", F.col("o_totalprice").alias("low"), (F.col("o_totalprice") + 25).alias("high"))
    return range_join(points, spans, "point", "low", "high", 100.0, how).select("event_id", "o_orderkey")


for _how in ("left", "right", "full"):
    query(_RANGE_OUTER.replace("{how}", _how.upper()), f"join_range_{_how}")(lambda t, how=_how: _range_outer(t, how))


@query("""
SELECT a.event_id, b.event_id AS last_view FROM (SELECT * FROM events WHERE event_type = 'purchase') a
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def join_asof(t):
    """Each purchase with its user's latest view."""
    left = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = t.events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("last_view"))
    return asof_join(left, right, ["user_id"], "ts", "ts", ["last_view"]).select("event_id", "last_view")


@query("""
SELECT c_custkey, o_orderkey, rank FROM (SELECT o_custkey AS c_custkey, o_orderkey,
row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3""")
def top_per_customer(t):
    rows = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return top_per_key(rows, ["c_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("c_custkey", "o_orderkey", "rank")


same_sql(
    "join_lateral",
    "SELECT n_nationkey, c_custkey FROM {nation}, LATERAL (SELECT c_custkey FROM {customer} WHERE c_nationkey = n_nationkey ORDER BY c_acctbal DESC, c_custkey LIMIT 2)",
)
