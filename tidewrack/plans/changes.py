"""Row changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.changes import delete_where, merge, update_where
from .query import query


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_acctbal < 0 THEN 'CLOSED' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def change_update(t):
    rows = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return update_where(rows, F.col("c_acctbal") < 0, c_acctbal=F.lit(0.0), c_mktsegment=F.lit("CLOSED"))


@query("SELECT p_partkey, p_size FROM part WHERE NOT (p_size > 25)")
def change_delete(t):
    return delete_where(t.part.select("p_partkey", "p_size"), F.col("p_size") > 25)


@query("SELECT s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 5 <> 0 UNION ALL SELECT s_suppkey + CASE WHEN s_suppkey % 15 = 0 THEN 1000000 ELSE 0 END, s_acctbal + 1 FROM supplier WHERE s_suppkey % 10 = 0 "
       "UNION ALL SELECT s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 10 = 0 AND s_suppkey % 15 = 0")
def change_merge(t):
    rows = t.supplier.select("s_suppkey", "s_acctbal")
    moved = F.col("s_suppkey") + F.when(F.col("s_suppkey") % 15 == 0, 1000000).otherwise(0)
    changes = rows.where("s_suppkey % 10 = 0").select(moved.alias("s_suppkey"), (F.col("s_acctbal") + 1).alias("s_acctbal"), F.lit(False).alias("deleted"))
    gone = rows.where("s_suppkey % 5 = 0 AND s_suppkey % 10 <> 0").select("s_suppkey", "s_acctbal", F.lit(True).alias("deleted"))
    return merge(rows, changes.unionByName(gone), "s_suppkey")
