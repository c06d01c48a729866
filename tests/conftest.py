import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from curation.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app="curation-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as plain tuples (sorted for set checks)."""
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]
