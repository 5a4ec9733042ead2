import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def docs(spark):
    from helpers import DOCS

    def build(*rows):
        """Documents from (id, text) pairs."""
        return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 2}", len(t or "")) for i, t in rows], DOCS)

    return build


@pytest.fixture(scope="session")
def small(spark):
    from helpers import SF

    return spark.read.parquet(f"{SF}/documents.parquet")
