import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hayloft.session import local_session, checkpoint_root

    session = local_session(4, shuffle_partitions=4)
    checkpoint_root(session)
    yield session


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *order):
    """Collect as a list of dicts, ordered by ``order`` (all columns if empty)."""
    cols = list(order) or df.columns
    return [r.asDict() for r in df.orderBy(*cols).collect()]
