import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from shelfline.session import build_session, release_staged  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=4, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def clean_staged(spark):
    yield
    release_staged(spark)


@pytest.fixture
def rows():
    """Sorted plain tuples of a frame."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
