from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starloom.session import Scratch, local_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", **{
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "3",
        "spark.default.parallelism": "3",
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def scratch(spark, tmp_path_factory):
    return Scratch(spark, str(tmp_path_factory.mktemp("scratch")))


@pytest.fixture(scope="session")
def tables():
    return TABLES
