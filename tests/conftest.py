import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import build_session

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tidemark-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__adaptive__coalescePartitions__initialPartitionNum="4",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "shared"),
        spark__sql__maxMetadataStringLength="5000",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip(f"no test tables at {path}")
    return path


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    saved = {}

    def apply(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield apply
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df):
    """Rows as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    """The physical plan text, before adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def helpers():
    class Helpers:
        pass

    Helpers.rows = staticmethod(rows)
    Helpers.plan = staticmethod(plan)
    return Helpers
