import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from nestloom.session import local_session

    return local_session(8, "tests")


@pytest.fixture()
def rows(spark):
    """``rows(ddl, (...), (...))``: a small table."""

    def build(schema, *values):
        return spark.createDataFrame(list(values), schema)

    return build


@pytest.fixture()
def scratch(spark):
    from nestloom.sources.scratch import new_path

    return lambda: new_path(spark, "test")
