import oracle
import pytest

from tidewrack.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


#: Queries that may find nothing in the smallest tables.
EMPTY = {"join_anti", "join_not_in"}


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert oracle.check(spark, con, QUERIES[name], ORACLES[name], SF) or name in EMPTY
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries()) >= set(QUERIES)


def test_approximations(spark):
    exact = {r.l_returnflag: r.n for r in QUERIES["agg_distinct_two_steps"](spark, SF).withColumnRenamed("parts", "n").collect()}
    for r in QUERIES["agg_approximate"](spark, SF).collect():
        assert abs(r.parts - exact[r.l_returnflag]) <= 0.1 * exact[r.l_returnflag]
