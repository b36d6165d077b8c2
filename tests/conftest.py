import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from faultline.session import get_spark, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", partitions=4, app="faultline-tests")
    shared_dir(s)  # the configured spark.checkpoint.dir, or a private one when unset
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as plain tuples (in the DataFrame's order)."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
