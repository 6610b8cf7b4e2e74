from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def scratch() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    from demandloom.session import local_session, ship_code

    ship_code()
    session = local_session(app="tests", memory="4g", **{
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"{scratch}/shared",
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.legacy.javaCharsets": "true",
    })
    yield session
    session.stop()


@pytest.fixture
def database(spark, request):
    name = "db_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return name


@pytest.fixture
def folder(scratch):
    return tempfile.mkdtemp(dir=scratch)


@pytest.fixture(scope="session")
def star(spark):
    from demandloom.sources.star_schema import StarSchema

    return StarSchema(spark, SMALL)


def rows(df, *order):
    """Rows as tuples, in the order of the given columns (or of all)."""
    order = order or tuple(df.columns)
    return [tuple(r) for r in df.orderBy(*order).collect()]
