import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from quire.session import local_session
    s = local_session("*", app="quire-tests", driver_memory="4g")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as plain tuples (optionally a column subset)."""
    d = df.select(*cols) if cols else df
    return [tuple(r) for r in d.collect()]
