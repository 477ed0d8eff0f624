import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docflow.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=8, shuffle_partitions=8, app="docflow-tests")
    yield s
    s.stop()


@pytest.fixture
def text_df(spark):
    def make(lines):
        return spark.createDataFrame([(x,) for x in lines], "value string")

    return make
