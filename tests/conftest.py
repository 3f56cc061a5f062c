from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from strandline.session import build_session, new_folder  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.driver.memory": "6g",
            "spark.log.level": "ERROR",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return new_folder(spark, "test")


@pytest.fixture(scope="session")
def data():
    return DATA


def as_set(df, *columns):
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}
