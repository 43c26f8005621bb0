import oracle
import pytest

from tidewrack.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    oracle.check(spark, con, QUERIES[name], ORACLES[name], SF)


def test_registry_is_complete():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
