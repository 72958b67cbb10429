import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from archivolt.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4)
    s.sparkContext.setLogLevel("OFF")
    ship_package(s)
    yield s


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples, columns in the order given."""

    def of(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: [(x is None, str(x)) for x in t])

    return of
