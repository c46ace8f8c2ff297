from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contactmine.session import build_session

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        "contactmine-tests",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


@pytest.fixture
def one(spark):
    """Value of a column expression over one row."""

    def value(make, **columns):
        fields = ", ".join(f"{name} string" for name in columns) or "x string"
        row = tuple(columns.values()) or (None,)
        df = spark.createDataFrame([row], fields)
        return df.select(make().alias("v")).first()["v"]

    return value
