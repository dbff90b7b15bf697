import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pressmill.session import build_session, clear_stages  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_stages(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def evaluate(spark):
    """Value of column expressions over one row."""
    def run(**columns):
        names, exprs = zip(*columns.items())
        row = spark.range(1).select(*[e.alias(n) for n, e in zip(names, exprs)]).first()
        return row[0] if len(names) == 1 else tuple(row)

    return run
