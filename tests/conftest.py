from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from gradewell.session import local_session  # noqa: E402

SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        app="tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalogue")),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_folder() -> str:
    if not SMALL.is_dir():
        pytest.skip("test tables are not there")
    return str(SMALL)


@pytest.fixture(scope="session")
def small(spark, small_folder):
    """The warehouse over the smallest derived exam data."""
    from gradewell.plans.warehouse import fixture_warehouse

    return fixture_warehouse(spark, small_folder)
