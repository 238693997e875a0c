import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from kindred.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    saved = {}

    def set_option(name, value):
        saved.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_option
    for name, value in saved.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def records(spark):
    """Normalised records from ``(entity_id, country, name, address[, source])`` rows."""

    def build(rows):
        schema = "entity_id string, country string, name string, address string"
        if rows and len(rows[0]) == 5:
            schema += ", source string"
        return spark.createDataFrame(rows, schema)

    return build


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())
