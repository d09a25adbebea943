import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quireworks.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        str(tmp_path_factory.mktemp("scratch")),
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    from quireworks.sources.store import CollectionStore

    return CollectionStore(spark, str(tmp_path / "store"))
