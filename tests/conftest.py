import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from blogweave.session import build_session
    s = build_session("local[8]", shuffle_partitions=8, app_name="blogweave-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples, sorted, optionally restricted to ``cols``."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
