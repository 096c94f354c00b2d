import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("work")
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": str(work / "checkpoint"),
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.sql.shuffle.partitions": "4",
            # many short queries: compile fast rather than best
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1 -XX:ReservedCodeCacheSize=512m",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"
