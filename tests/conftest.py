import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from tandem.catalog import base  # noqa: E402
from tandem.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session("tests", cores=8, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture(scope="session")
def records(spark, folder):
    return base.records(spark, folder)


@pytest.fixture(scope="session")
def prepared(spark, folder):
    return base.prepared(spark, folder)


@pytest.fixture(scope="session")
def model(spark, folder):
    return base.features(spark, folder)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
