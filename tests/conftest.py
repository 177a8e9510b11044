import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from newslens.session import apply_session_conf, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "newslens-tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    apply_session_conf(session)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Small DataFrame from tuples and a DDL schema."""
    return lambda data, ddl: spark.createDataFrame(data, ddl)


def tuples(df, *order):
    ordered = df.orderBy(*order) if order else df
    return [tuple(row) for row in ordered.collect()]
