import tempfile

import pytest

from tidemark.workspace import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        "tidemark-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-test-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
