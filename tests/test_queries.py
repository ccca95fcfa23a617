import os

import pytest

import tandemtext.queries as core
from tests.oracle import connection, differences

SF = os.environ.get("TANDEMTEXT_TEST_SF", "/root/testdata/sf0.001")
PARTS = {name: (query, part.SQL.get(name)) for part in core.modules() for name, query in part.QUERIES.items()}


@pytest.fixture(scope="module")
def db():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(PARTS))
def test_query(spark, db, name):
    query, sql = PARTS[name]
    if sql is None:
        assert query(spark, SF).count() >= 0
    else:
        assert differences(spark, db, query, sql, SF) == ""


def test_flagship(spark):
    assert core.flagship(spark, SF).count() > 0
