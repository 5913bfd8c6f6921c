from __future__ import annotations

import pytest

from curbline.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a small typed frame: ``frame("a int, b string", (1, "x"), ...)``."""

    def build(schema: str, *rows: tuple):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture
def rows():
    """The rows of a frame as a sorted list of tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))

    return collect
