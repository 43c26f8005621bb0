"""Reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from .query import query, same_sql


_NATIONS = range(25)


@query(f"SELECT c_mktsegment, {', '.join(f'count(*) FILTER (c_nationkey = {i}) AS n{i}' for i in _NATIONS)} FROM customer GROUP BY c_mktsegment")
def pivot_counts(t):
    rows = t.customer.groupBy("c_mktsegment").pivot("c_nationkey", list(_NATIONS)).agg(F.count("c_custkey"))
    return rows.select("c_mktsegment", *[F.coalesce(F.col(str(i)), F.lit(0)).alias(f"n{i}") for i in _NATIONS])


@query("SELECT s_suppkey, 'balance' AS measure, s_acctbal AS value FROM supplier UNION ALL SELECT s_suppkey, 'nation', s_nationkey::DOUBLE FROM supplier")
def unpivot_measures(t):
    rows = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation"))
    return rows.unpivot("s_suppkey", ["balance", "nation"], "measure", "value")


@query("SELECT label, i, round(avg(v), 5) AS mean FROM (SELECT label, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY label, i")
def explode_positions(t):
    rows = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v"))
    return rows.groupBy("label", F.col("i").cast("bigint").alias("i")).agg(F.round(F.avg(F.col("v").cast("double")), 5).alias("mean"))


@query()
def sample_rows(t):
    """A seeded Bernoulli sample; which rows it takes is Spark's own."""
    return t.orders.sample(fraction=0.1, seed=7).select("o_orderkey")


same_sql("values_inline", "SELECT v.k, n_name FROM (VALUES (1, 'one'), (2, 'two')) AS v(k, name) JOIN {nation} ON n_nationkey = v.k")
