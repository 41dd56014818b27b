import warnings

import pytest

from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    warnings.simplefilter("ignore")
    return connect(DATA)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, DATA, name).startswith("ok")
