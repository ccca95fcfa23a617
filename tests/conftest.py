from __future__ import annotations

import pytest

from tandemtext.session import get_spark


#: Made on import: the parameters of tests hold column expressions, which need a session.
SESSION = get_spark("local[4]", shuffle_partitions=4)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def one(spark):
    """Value of a column expression over the given fields."""

    def run(expression, schema: str, *values):
        return spark.createDataFrame([values], schema).select(expression.alias("x")).first()[0]

    return run
