"""Set operations."""

from __future__ import annotations

from .query import same_sql

_A, _B = "SELECT c_nationkey AS k FROM {customer} WHERE c_acctbal > 0", "SELECT s_nationkey AS k FROM {supplier} WHERE s_acctbal > 5000"
for _name, _op in (("union", "UNION"), ("union_all", "UNION ALL"), ("intersect", "INTERSECT"), ("intersect_all", "INTERSECT ALL"), ("except", "EXCEPT"), ("except_all", "EXCEPT ALL")):
    same_sql(f"set_{_name}", f"SELECT k, count(*) AS n FROM ({_A} {_op} {_B}) GROUP BY k")
same_sql("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM {orders}")
