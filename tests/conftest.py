import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from geocadence.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "geocadence-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *order):
    """Sorted plain tuples of a small result."""
    cols = order or df.columns
    return sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
