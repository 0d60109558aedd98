"""Every query against its SQL oracle: column names, types and rows."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tidemark.plans.catalogue import QUERIES
from tidemark.plans.oracle import ORACLE

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys() and driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    answer = duck.execute(ORACLE[name])
    types = {column[0]: str(column[1]) for column in answer.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    columns = [column[0] for column in answer.description]
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(answer.fetchall(), columns)


SETTINGS = {
    "spark.sql.session.timeZone": "America/New_York",
    "spark.sql.ansi.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
SENSITIVE = [
    "normalize_live", "parse_ts", "cast_times", "iso_times", "queue_flatten", "landing_path", "latest_as_of",
    "latest_batch", "pick_snapshot_rows", "snapshots", "expire_plan", "expire_report", "land_flatten",
    "filter_then_latest", "latest_then_filter", "star_board", "current_board", "operating_ratio", "catalogued_only",
    "bronze_roundtrip",
]


@pytest.mark.parametrize("name", SENSITIVE)
def test_result_does_not_depend_on_the_session(spark, sf_dir, duck, settings, name):
    settings(**{key.replace(".", "__"): value for key, value in SETTINGS.items()})
    df = driver.queries()[name](spark, sf_dir)
    answer = duck.execute(driver.oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(answer.fetchall(), columns)


def test_entry_runs(spark):
    assert driver.entry(spark).columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]


def test_stated_schemas_are_those_of_the_files(spark, sf_dir):
    from tidemark.plans.catalogue import TABLES, read

    for name in TABLES:
        assert read(spark, sf_dir, name).dtypes == spark.read.parquet(f"{sf_dir}/{name}.parquet").dtypes
