"""The registered queries of this package that SQL can express, against their SQL."""

import glob
import os

import duckdb
import pytest

from tidemark.llm.queries import ORACLE, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def test_every_sql_has_its_query():
    assert ORACLE.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = QUERIES[name](spark, sf_dir)
    answer = con.execute(ORACLE[name])
    types = {column[0]: str(column[1]) for column in answer.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    want = sorted(str(r) for r in answer.fetchall())
    assert sorted(str(tuple(r)) for r in df.select(*types).collect()) == want
