import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("4", shuffle_partitions=4, memory="4g", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    return [tuple(r) if len(r) > 1 else r[0] for r in df.select(*columns).collect()]


def bag_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
