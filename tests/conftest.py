from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from golden_rows import golden_rows  # noqa: E402

from loanproof.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture(scope="session")
def golden(spark):
    columns = "row_id int, age int, state string, default_12m int, score double"
    return spark.createDataFrame(golden_rows(), columns).cache()


@pytest.fixture(scope="session")
def apps(spark):
    from loanproof.sources.applications import build_applications

    return build_applications(spark, SMALL).cache()
