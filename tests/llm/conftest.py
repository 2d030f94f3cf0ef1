import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import CLASH, SCHEMA, corpus  # noqa: E402


@pytest.fixture(scope="session")
def make(spark):
    def frame(rows, source=lambda i: f"s{i % 2}", lang=lambda i: "en"):
        """Documents with extra columns of clashing names, from (doc_id, text) rows."""
        data = [(d, t, lang(i), source(i), len(t) if t else None, *CLASH) for i, (d, t) in enumerate(rows)]
        return spark.createDataFrame(data, SCHEMA).repartition(3)
    return frame


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return corpus()
