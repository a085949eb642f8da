import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tillstream.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    settings = {
        "spark.checkpoint.dir": str(folder),
        "spark.sql.warehouse.dir": f"{folder}/warehouse",
        "spark.sql.shuffle.partitions": "2",
    }
    session = local_session(4, "tests", **settings)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda frame: sorted((tuple(r) for r in frame.collect()), key=repr)
