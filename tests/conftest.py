import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from reviewlens.session import local_session

    session = local_session("tests", 8, shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Values of expressions over one literal row."""

    def run(schema, row, *exprs):
        df = spark.createDataFrame([row], schema)
        return list(df.select(*[e.alias(f"c{n}") for n, e in enumerate(exprs)]).first())

    return run
