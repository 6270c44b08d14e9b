import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from sievework.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                            spark__driver__memory="8g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
    return collect
