import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lendscope.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8, driver_memory="4g", app="lendscope-tests",
                      checkpoint_dir=tempfile.mkdtemp(prefix="lendscope-tests-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a list of tuples ordered by the first column."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.select(*cols).orderBy(cols[0]).collect()]
