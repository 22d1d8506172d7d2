import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelwatch.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "2"})
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, in a fixed order."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
