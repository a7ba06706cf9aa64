"""Every registered query against DuckDB on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from measure_rollup.plans import catalog

TABLES = Path("/root/testdata")


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def folder(request):
    path = TABLES / request.param
    if not path.is_dir():
        pytest.skip(f"{path} is missing")
    return path


def _oracle(folder, sql):
    connection = duckdb.connect()
    for file in folder.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    result = connection.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert catalog.QUERIES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_oracle(spark, folder, name):
    df = contract.queries()[name](spark, str(folder))
    columns, expected = _oracle(folder, contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(columns)
    assert {t for _, t in df.dtypes} <= {"bigint", "double", "string"}
    actual = [tuple(row) for row in df.collect()]
    assert actual, "no rows"
    assert _sorted(df.columns, actual) == _sorted(columns, expected)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 1 and rows[0].report.startswith("{AUTOMOBILE=")
