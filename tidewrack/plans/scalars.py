"""Scans, filters, projections and scalar functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf

from ..functions.vectors import norm
from ..operators.nearest import nearest
from .query import query, same_sql

same_sql("scan_two_columns", "SELECT l_orderkey, l_quantity FROM {lineitem}")
same_sql("filter_range", "SELECT o_orderkey FROM {orders} WHERE o_totalprice BETWEEN 50000 AND 90000 AND o_orderstatus IN ('F', 'P')")
same_sql("filter_like", "SELECT p_partkey FROM {part} WHERE p_type LIKE '%O_O%' OR p_name ILIKE '%T_1%'")
same_sql("filter_null", "SELECT event_id FROM {events} WHERE nullif(event_type, 'error') IS NULL OR NOT (nullif(user_id, 7) IS NOT NULL)")
same_sql("filter_not_distinct", "SELECT doc_id FROM {documents} WHERE nullif(lang, 'en') IS NOT DISTINCT FROM NULL")
same_sql("project_case", "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class, coalesce(nullif(p_brand, 'Brand#11'), 'none') AS brand FROM {part}")
same_sql("cast_try", "SELECT o_orderkey, try_cast(substr(o_orderpriority, 1, 1) AS INT) AS level, try_cast(o_orderpriority AS INT) AS bad FROM {orders}")
same_sql(
    "strings_basic",
    "SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, length(p_name) AS len, substr(p_name, 1, 4) AS head, replace(p_type, ' ', '_') AS joined, concat(p_brand, '/', p_type) AS both_names, "
    "reverse(p_brand) AS back, lpad(CAST(p_size AS VARCHAR(9)), 4, '0') AS padded, trim(concat('  ', p_brand, ' ')) AS trimmed, position('a' IN p_name) AS at FROM {part}",
    "SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, length(p_name)::INT AS len, substr(p_name, 1, 4) AS head, replace(p_type, ' ', '_') AS joined, concat(p_brand, '/', p_type) AS both_names, "
    "reverse(p_brand) AS back, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, trim(concat('  ', p_brand, ' ')) AS trimmed, position('a' IN p_name)::INT AS at FROM part",
)
same_sql("strings_split", "SELECT p_partkey, split_part(p_type, ' ', 1) AS first_word, split_part(p_type, ' ', 2) AS second_word FROM {part}")
same_sql("hashes", "SELECT c_custkey, md5(c_name) AS m, sha2(c_name, 256) AS s FROM {customer}", "SELECT c_custkey, md5(c_name) AS m, sha256(c_name) AS s FROM customer")
same_sql(
    "numbers",
    "SELECT l_orderkey, l_partkey, l_linenumber, abs(l_tax - l_discount) < 0.05 AS near, floor(l_extendedprice) AS fl, ceil(l_extendedprice) AS ce, round(sqrt(l_extendedprice), 6) AS root, "
    "round(ln(l_quantity), 6) AS logn, l_linenumber % 3 AS rem, greatest(l_tax, l_discount) AS most, sign(l_discount - 0.05) AS sgn, round(power(l_quantity, 2), 2) AS sq FROM {lineitem}",
    "SELECT l_orderkey, l_partkey, l_linenumber, abs(l_tax - l_discount) < 0.05 AS near, floor(l_extendedprice)::BIGINT AS fl, ceil(l_extendedprice)::BIGINT AS ce, round(sqrt(l_extendedprice), 6) AS root, "
    "round(ln(l_quantity), 6) AS logn, l_linenumber % 3 AS rem, greatest(l_tax, l_discount) AS most, sign(l_discount - 0.05)::DOUBLE AS sgn, round(power(l_quantity, 2), 2) AS sq FROM lineitem",
)
same_sql("divide_safely", "SELECT s_suppkey, try_divide(s_acctbal, s_nationkey) AS q, CAST(s_suppkey AS BIGINT) div 7 AS whole FROM {supplier}", "SELECT s_suppkey, CASE WHEN s_nationkey = 0 THEN NULL ELSE s_acctbal / s_nationkey END AS q, s_suppkey // 7 AS whole FROM supplier")
same_sql(
    "dates",
    "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, quarter(o_orderdate) AS q, datediff(DATE '1999-01-01', CAST(o_orderdate AS DATE)) AS age, "
    "date_format(o_orderdate, 'yyyy-MM') AS ym, date_format(o_orderdate + INTERVAL 1 MONTH, 'yyyy-MM-dd') AS due, date_format(date_trunc('QUARTER', o_orderdate), 'yyyy-MM-dd') AS qs FROM {orders}",
    "SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, day(o_orderdate)::INT AS d, quarter(o_orderdate)::INT AS q, date_diff('day', o_orderdate::DATE, DATE '1999-01-01')::INT AS age, "
    "strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS due, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS qs FROM orders",
)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY event_type")
def json_parsed(t):
    return t.events.withColumn("p", F.from_json("props", "k bigint")).groupBy("event_type").agg(F.sum("p.k").alias("k"))


@query("""
SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS positive, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 5) AS square, list_max(embedding)::DOUBLE AS top,
len(list_slice(embedding, 3, 10)) AS sliced, list_contains([label], label) AS has FROM embeddings""")
def arrays_and_lambdas(t):
    e = F.col("embedding")
    return t.embeddings.select(
        "vec_id",
        F.size(F.filter(e, lambda x: x > 0)).cast("bigint").alias("positive"),
        F.round(F.aggregate(F.transform(e, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x), 5).alias("square"),
        F.array_max(e).cast("double").alias("top"),
        F.size(F.slice(e, 3, 8)).cast("bigint").alias("sliced"),
        F.array_contains(F.array("label"), F.col("label")).alias("has"),
    )


@query("SELECT c_mktsegment, cardinality(m) AS entries, m['0'] AS at_zero FROM (SELECT c_mktsegment, map_from_entries(list({'k': c_nationkey::VARCHAR, 'v': n})) AS m FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL) GROUP BY c_mktsegment)")
def maps(t):
    rows = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))
    rows = rows.groupBy("c_mktsegment").agg(F.map_from_entries(F.collect_list(F.struct(F.col("c_nationkey").cast("string"), "n"))).alias("m"))
    return rows.select("c_mktsegment", F.size("m").cast("bigint").alias("entries"), F.try_element_at("m", F.lit("0")).alias("at_zero"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 5) AS length FROM embeddings")
def vector_norms(t):
    return t.embeddings.select("vec_id", F.round(norm(F.col("embedding")), 5).alias("length"))


@query("""
SELECT q, vec_id, rank FROM (SELECT a.vec_id AS q, b.vec_id AS vec_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) DESC, b.vec_id) AS rank
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0) WHERE rank <= 5""")
def vector_nearest(t):
    """The five nearest by cosine of the query set (ids divisible by 100) among all vectors: each block of vectors meets all queries."""
    return nearest(t.embeddings, t.embeddings.where("vec_id % 100 = 0"), "vec_id", "embedding", 5).select("q", "vec_id", "rank")


@query("SELECT l_orderkey, l_partkey, l_linenumber, floor(l_extendedprice * (1 - l_discount) * (1 + l_tax) + 0.5)::BIGINT AS charge FROM lineitem")
def udf_pandas(t):
    @pandas_udf("double")
    def charge(price: pd.Series, discount: pd.Series, tax: pd.Series) -> pd.Series:
        return price * (1 - discount) * (1 + tax)

    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.floor(charge("l_extendedprice", "l_discount", "l_tax") + 0.5).alias("charge"))


@query("SELECT n_regionkey, max(n_nationkey) - min(n_nationkey) AS spread FROM nation GROUP BY n_regionkey")
def udf_aggregate(t):
    @pandas_udf("int")
    def spread(x: pd.Series) -> int:
        return int(x.max() - x.min())

    return t.nation.groupBy("n_regionkey").agg(spread("n_nationkey").alias("spread"))


@query("SELECT n_nationkey, unnest(range(0, n_nationkey % 3 + 1))::INT AS i FROM nation")
def udf_table(t):
    @udtf(returnType="i int")
    class Count:
        def eval(self, n: int):
            for i in range(n % 3 + 1):
                yield (i,)

    t.spark.udtf.register("tidewrack_count", Count)
    return t.sql("SELECT n_nationkey, i FROM {nation}, LATERAL tidewrack_count(n_nationkey)")
