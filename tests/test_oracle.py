"""Every registered query against its SQL in DuckDB."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _sorted(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", [name for name in entry.queries() if name in ORACLES])
def test_query_equals_oracle(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    names = sorted(frame.columns)
    ours = _sorted(tuple(row) for row in frame.select(*names).collect())
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == names
    theirs = _sorted(relation.select(*[f'"{column}"' for column in names]).fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: _kind(t) for c, t in frame.dtypes} == {c: _kind(k.lower()) for c, k in kinds.items()}


def _kind(name):
    # DuckDB's type names and Spark's.
    return {
        "varchar": "string", "integer": "int", "int": "int", "smallint": "smallint", "bigint": "bigint",
        "float": "float", "boolean": "boolean", "date": "date",
    }.get(name, name)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
