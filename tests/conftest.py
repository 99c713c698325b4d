import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Fixed start of every fixture (the reference takes it from the clock).
T = dt.datetime(2018, 1, 1, 10, 0, 0)


def at(seconds: float) -> dt.datetime:
    return T + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def spark():
    from clickguard.session import local_session

    s = local_session(8, shuffle_partitions=8, app="clickguard-tests")
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None) \
            and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickguard-test-ckpt-"))
    yield s


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="clickguard-test-")


def events_df(spark, rows):
    from clickguard.schema import EVENT

    return spark.createDataFrame(rows, EVENT)


def rows_of(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
