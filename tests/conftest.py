import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ratings_engine.config import build_session
    s = build_session("local[4]", app="ratings_engine-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="re-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="re-test-")


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparison)."""
    d = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in d.collect())
