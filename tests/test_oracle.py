"""Every registered query against its SQL counterpart."""

import pytest

from tests.compare import difference, duck
from tests.conftest import FOLDER
from tillmark.plans.oracle import ORACLE
from tillmark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None
