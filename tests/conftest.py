import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_oracle import connect, session  # noqa: E402

SF = "/root/testdata/sf0.001"
CATALOG = os.path.join(os.path.dirname(os.path.abspath(__file__)), "catalog")


@pytest.fixture(scope="session")
def spark():
    return session("4")


@pytest.fixture(scope="session")
def duck():
    return connect(SF)


def rows(df, *order):
    """Collected rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr) if not order else [
        tuple(r) for r in df.orderBy(*order).collect()
    ]
