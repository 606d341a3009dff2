import pytest

from __spark_entry__ import entry, oracle_sql, queries
from cinerank.oracles import ORACLES
from cinerank.queries import QUERIES
from tests.oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL).toPandas(), ORACLES[name], con) == []


def test_entry(spark):
    assert entry(spark).count() == 200
