import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from agrimill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4, memory="6g")


@pytest.fixture(scope="session")
def raw(spark):
    """Untyped table: ``raw("a,b", [("1", None), ...])``, every column text."""

    def make(columns, rows):
        names = [c.strip() for c in columns.split(",")]
        return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))

    return make


def rows(df, *columns, sort=True):
    picked = df.select(*columns) if columns else df
    out = [tuple(r) for r in picked.collect()]
    return sorted(out, key=repr) if sort else out


def ring(x, y, w, h):
    x, y, w, h = float(x), float(y), float(w), float(h)
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
