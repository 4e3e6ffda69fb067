import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_session
    s = get_session("local[4]", 4, app_name="quarry-tests")
    yield s
    s.stop()


def make_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING")


@pytest.fixture
def docs_factory(spark):
    return lambda rows: make_docs(spark, rows)
