from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tilescope.config import local_session  # noqa: E402
from tilescope.sources.canvas import CANVAS_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="tilescope-tests")
    yield s


def ts(text: str) -> datetime:
    for fmt in ("%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M"):
        try:
            return datetime.strptime(text, fmt)
        except ValueError:
            pass
    raise ValueError(text)


@pytest.fixture
def canvas(spark):
    """Build a canvas DataFrame from (time text, user, x, y, colour) tuples."""

    def make(rows):
        data = [(ts(t) if isinstance(t, str) else t, u, x, y, c) for t, u, x, y, c in rows]
        return spark.createDataFrame(data, CANVAS_SCHEMA)

    return make


def rows(df, order=None):
    out = [tuple(r) for r in df.collect()]
    return out if order is False else sorted(out, key=repr)
