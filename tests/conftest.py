import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidewell.session import drop_cuts, local_session

    s = local_session("4", 4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    drop_cuts()
    s.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a frame's rows."""

    def take(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)

    return take
