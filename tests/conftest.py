from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from autoledger.catalog import Lake  # noqa: E402
from autoledger.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    active = session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "shared"),
        },
    )
    active.sparkContext.setLogLevel("ERROR")
    yield active
    active.stop()


@pytest.fixture
def settings(spark):
    """Session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def lake(spark, tmp_path):
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    return Lake(spark, str(tmp_path / "lake"), prefix=prefix).create_databases()


def plan_of(rows) -> str:
    """The physical plan; the final one where the query has run."""
    return rows._jdf.queryExecution().executedPlan().toString()


def as_set(rows, *columns) -> list[tuple]:
    picked = rows.select(*columns) if columns else rows
    return sorted((tuple(row) for row in picked.collect()), key=repr)
