"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import distinct_counts, salted
from .query import query, same_sql


@query("""
SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS sum_base_price,
CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS sum_disc_price, round(avg(l_quantity), 6) AS avg_qty, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""")
def pricing_summary(t):
    money = lambda c: F.sum(c.cast("decimal(18,4)")).cast("double")
    rows = t.lineitem.where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").cast("bigint").alias("sum_qty"),
        money(F.col("l_extendedprice")).alias("sum_base_price"),
        money(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sum_disc_price"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
        F.count("*").alias("count_order"),
    )


same_sql("agg_min_max", "SELECT p_brand, min(p_size) AS lo, max(p_size) AS hi, min(p_name) AS first_name, max(p_retailprice) AS dearest FROM {part} GROUP BY p_brand")
same_sql("agg_having", "SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey HAVING count(*) > 12")
same_sql("agg_filter", "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM {orders} GROUP BY o_orderpriority")
same_sql("agg_global", "SELECT count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, CAST(sum(l_linenumber) AS BIGINT) AS s, bool_and(l_quantity > 0) AS positive FROM {lineitem}")
same_sql("agg_grouping_sets", "SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g, count(*) AS n FROM {lineitem} GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")
same_sql("agg_rollup", "SELECT p_brand, p_size, count(*) AS n FROM {part} GROUP BY ROLLUP (p_brand, p_size)")
same_sql("agg_cube", "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM {customer} GROUP BY CUBE (c_mktsegment, c_nationkey)")
same_sql("agg_median", "SELECT l_returnflag, median(l_quantity) AS med FROM {lineitem} GROUP BY l_returnflag")
same_sql(
    "agg_percentile",
    "SELECT l_linestatus, percentile_cont(0.25) WITHIN GROUP (ORDER BY l_quantity) AS q1, percentile_cont(0.9) WITHIN GROUP (ORDER BY l_quantity) AS p90 FROM {lineitem} GROUP BY l_linestatus",
)
same_sql("agg_max_by", "SELECT n_regionkey, max_by(n_name, n_nationkey) AS last_name, min_by(n_name, n_nationkey) AS first_name FROM {nation} GROUP BY n_regionkey")
same_sql("agg_statistics", "SELECT l_linestatus, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS var, round(corr(l_quantity, l_linenumber), 6) AS r FROM {lineitem} GROUP BY l_linestatus")
same_sql("agg_distinct_pairs", "SELECT count(*) AS n FROM (SELECT DISTINCT l_partkey, l_suppkey FROM {lineitem})")


@query("""
SELECT p_brand, p_size AS usual_size FROM (SELECT p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_size) AS nth FROM part GROUP BY p_brand, p_size) WHERE nth = 1""")
def agg_mode(t):
    """The most frequent value, of equally frequent ones the smallest."""
    return t.part.groupBy("p_brand").agg(F.mode("p_size", True).alias("usual_size"))


@query("SELECT r_name, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def agg_strings(t):
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("r_name").agg(F.array_join(F.sort_array(F.collect_list("n_name")), ",").alias("names"))


@query("SELECT c_nationkey, list_sort(list(DISTINCT c_mktsegment)) AS segments FROM customer GROUP BY c_nationkey")
def agg_sets(t):
    return t.customer.groupBy("c_nationkey").agg(F.sort_array(F.collect_set("c_mktsegment")).alias("segments"))


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag")
def agg_distinct_two_steps(t):
    return distinct_counts(t.lineitem, ["l_returnflag"], "l_partkey", "parts")


@query("SELECT event_type, count(*) AS n, max(value) AS top FROM events GROUP BY event_type")
def agg_salted(t):
    rows = t.events.select("event_id", "event_type", "value")
    return salted(rows, ["event_type"], {"n": F.count("*"), "top": F.max("value")}, {"n": F.sum("n"), "top": F.max("top")})


@query()
def agg_approximate(t):
    """Sketches differ between engines, so this has no SQL to compare with; a test bounds its error."""
    return t.lineitem.groupBy("l_returnflag").agg(
        F.approx_count_distinct("l_partkey", 0.02).alias("parts"), F.percentile_approx("l_quantity", 0.5, 1000).alias("middle")
    )
