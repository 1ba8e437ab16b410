import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallyloom.session import local_session

    session = local_session(
        "tests", 8, **{"spark.driver.memory": "8g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
