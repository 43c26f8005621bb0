"""Scripts of several statements."""

from __future__ import annotations

from ..operators.scripts import run_script
from .query import query

_SCRIPT = """
-- a view, a mistake; and two queries
CREATE OR REPLACE TEMPORARY VIEW tidewrack_rich AS SELECT c_custkey, c_nationkey, ';' AS mark FROM tidewrack_customer WHERE c_acctbal > 5000;
SELECT no_such_column FROM tidewrack_rich;
SELECT c_nationkey, count(*) AS n, any_value(mark) AS mark FROM tidewrack_rich GROUP BY c_nationkey; /* the second; */
SELECT -1 AS c_nationkey, count(*) AS n, 'all' AS mark FROM tidewrack_rich
"""


@query("""
SELECT c_nationkey, count(*) AS n, ';' AS mark FROM customer WHERE c_acctbal > 5000 GROUP BY c_nationkey
UNION ALL SELECT -1, count(*), 'all' FROM customer WHERE c_acctbal > 5000""")
def script_statements(t):
    """A script whose second statement fails and that goes on."""
    t.customer.createOrReplaceTempView("tidewrack_customer")
    results = run_script(t.spark, _SCRIPT, go_on=True)
    return results[2].rows.union(results[3].rows)
