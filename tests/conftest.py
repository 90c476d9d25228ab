from __future__ import annotations

import pytest

from lakeloom.session import build_session, scratch_path


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        settings={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "test")
